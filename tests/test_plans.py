"""Physical-plan shape of the headline operators: the scale properties the README claims."""

from snapflow.plans import table_queries as tq

from conftest import SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")


def test_snapshot_filters_reach_scan(spark):
    _static(spark)
    try:
        p = _plan(tq.q_snapshot_merge(spark, SF01))
        assert "SortMergeJoin" in p and "FullOuter" in p
        assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_top1_is_partial_window_group_limit(spark):
    _static(spark)
    try:
        p = _plan(tq.q_dedupe_top1(spark, SF01))
        assert p.count("WindowGroupLimit") >= 2          # partial before, final after exchange
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_person_count_is_aggregate_not_window(spark):
    _static(spark)
    try:
        p = _plan(tq.q_person_key(spark, SF01))
        assert "Window" not in p.replace("WindowGroupLimit", "")
        assert "HashAggregate" in p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_persistent_view_prunes_text(spark):
    p = _plan(tq.q_persistent_view(spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in \
        tq.q_persistent_view(spark, SF01)._jdf.queryExecution().executedPlan().toString() or \
        "text" not in p.split("documents")[-1].split("]")[0]
