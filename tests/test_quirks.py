"""Quirk register and merge invariants (SURVEY §5c)."""

import os

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from snapflow.operators import dedupe, merge as M
from snapflow.plans import member_extract as ME, super_users as SU
from snapflow.schemas import SchemaError
from snapflow.sources.delimited import read_delimited, write_delimited

from conftest import SF

SPEC = M.spec("k", ["k", "v"], ["v"])
AS_OF = "2024-01-26 04:00:00"

snapshots = st.dictionaries(st.integers(0, 30), st.sampled_from(["a", "b", None]), max_size=25)


@settings(max_examples=8, deadline=None)
@given(snapshots, snapshots)
def test_merge_invariants(spark, first, second):
    """Every target key survives; outcome counts equal the key-set differences; merging the
    same snapshot again changes nothing."""
    def frame(d):
        return spark.createDataFrame([(k, v) for k, v in d.items()], "k long, v string")

    empty = M.empty_target(spark, SPEC, frame(first).schema)
    t1 = M.snapshot_merge(empty, frame(first), SPEC, AS_OF)
    out = M.snapshot_merge(t1, frame(second), SPEC, "2024-02-26 04:00:00", with_action=True)
    rows = {r["k"]: r for r in out.collect()}
    assert set(rows) == set(first) | set(second)
    acts = [r["merge_action"] for r in rows.values()]
    assert acts.count("insert") == len(set(second) - set(first))
    assert acts.count("drop") == len(set(first) - set(second))
    changed = {k for k in set(first) & set(second)
               if first[k] is not None and second[k] is not None and first[k] != second[k]}
    assert {k for k, r in rows.items() if r["merge_action"] == "update"} == changed
    again = M.snapshot_merge(out.drop("merge_action"), frame(second), SPEC,
                             "2024-03-26 04:00:00", with_action=True)
    assert {r["merge_action"] for r in again.collect()} <= {"unchanged", "still_dropped"}


def test_q3_top1_is_permutation_invariant(spark):
    """Q3: ties in the ranking order are broken by the remaining columns, so the chosen row
    does not depend on input order or partitioning."""
    o = spark.read.parquet(f"{SF}/orders.parquet")
    base = sorted(map(tuple, dedupe.top1_per_key(o, "o_custkey", ["-o_orderpriority"]).collect()))
    shuffled = o.repartition(7, F.rand(11)).sortWithinPartitions(F.rand(5))
    again = sorted(map(tuple, dedupe.top1_per_key(shuffled, "o_custkey",
                                                  ["-o_orderpriority"]).collect()))
    assert base == again


def test_q6_leading_zeros_kept(spark, tmp):
    """Q6: feeds are read as text, so codes keep their leading zeros."""
    df = spark.createDataFrame([("001", "00420"), ("010", "07")], "plan string, zip string")
    write_delimited(df, os.path.join(tmp, "f"))
    got = sorted(map(tuple, read_delimited(spark, os.path.join(tmp, "f"), ["plan", "zip"],
                                           file_col=None).good.collect()))
    assert got == [("001", "00420"), ("010", "07")]


def test_q9_ingest_stamp_is_batch_constant(spark, tmp):
    """Q9: one ingest time per load, not per row, so DISTINCT is not defeated."""
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("a")).repartition(5)
    write_delimited(df, os.path.join(tmp, "f"))
    g = read_delimited(spark, os.path.join(tmp, "f"), ["a"], lineage_as_of=AS_OF).good
    assert g.select("date_ingested").distinct().count() == 1
    assert g.select("FileName").distinct().count() == 5


def test_q10_origin_from_file_pattern(spark, tmp):
    """Q10: C&S origin follows the file pattern even when both workbooks use one sheet name."""
    from xlsx_util import write_xlsx
    from snapflow.plans.super_users import Config, run
    from snapflow.operators.sinks import open_table
    for origin, key in (("mcr", "K1"), ("mcd", "K2")):
        os.makedirs(os.path.join(tmp, origin))
        write_xlsx(os.path.join(tmp, origin, f"{origin}_book.xlsx"), SU.CS_COLUMNS,
                   [[key if c == "Member_Key" else None for c in SU.CS_COLUMNS]])
    ei_cols = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in SU.EI_COLUMNS))
    aco = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in SU.EI_ACO_COLUMNS))
    for d, df in (("ei", ei_cols), ("aco", aco)):
        write_delimited(df, os.path.join(tmp, d), sep="\t")
    os.makedirs(os.path.join(tmp, "mr"))
    write_xlsx(os.path.join(tmp, "mr", "mr.xlsx"), SU.MR_COLUMNS, [])
    cfg = Config(ei=os.path.join(tmp, "ei"), ei_aco=os.path.join(tmp, "aco"),
                 mr=os.path.join(tmp, "mr"), cs_mcr=os.path.join(tmp, "mcr"),
                 cs_mcd=os.path.join(tmp, "mcd"), target=os.path.join(tmp, "t"))
    run(spark, cfg, AS_OF)
    got = {r["Member_ID"]: r["CS_file_origin"] for r in open_table(spark, cfg.target).read().collect()}
    assert got == {"K1": "medicare", "K2": "medicaid"}


def test_q14_table_width_wins(spark):
    """Q14: names wider than the table column are cut to the table width (100)."""
    stage = spark.createDataFrame([tuple("x" * 300 if c == "MBR_LST_NM" else
                                         ("201909" if c == "RPT_MO_KEY" else "")
                                         for c in ME.FEED_COLUMNS)],
                                  ", ".join(f"`{c}` string" for c in ME.FEED_COLUMNS))
    stage = stage.withColumn("Date_Ingested", F.lit(AS_OF)).withColumn("FileName", F.lit("f"))
    row = ME.typed_source(stage).first()
    assert len(row["MBR_LST_NM"]) == 100


def test_q15_distinct_on_mr_only(spark):
    """Q15: identical M&R rows collapse; identical C&S rows are kept (no DISTINCT there)."""
    def frame(cols, rows):
        full = cols + ["date_ingested", "FileName"]
        data = [[r.get(c) for c in cols] + [AS_OF, "f"] for r in rows]
        df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in full))
        return df.withColumn("date_ingested", F.col("date_ingested").cast("timestamp_ntz"))
    mr = frame(SU.MR_COLUMNS, [{"hicn": "M1"}, {"hicn": "M1"}])
    cs = frame(SU.CS_COLUMNS + ["file_origin"], [{"Member_Key": "C1", "file_origin": "mcr"}] * 2)
    ei = frame(SU.EI_COLUMNS, [])
    aco = frame(SU.EI_ACO_COLUMNS, [])
    ids = [r["Member_ID"] for r in SU.build_source(ei, aco, mr, cs).collect()]
    assert sorted(ids) == ["C1", "C1", "M1"]


def test_q19_errors_are_not_swallowed(spark, tmp):
    """Q19: an unknown feed column fails the load instead of being ignored."""
    df = spark.createDataFrame([("1", "2")], "a string, surprise string")
    write_delimited(df, os.path.join(tmp, "f"))
    with pytest.raises(SchemaError, match="surprise"):
        read_delimited(spark, os.path.join(tmp, "f"), ["a", "b"])
