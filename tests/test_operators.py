"""Operator behaviour on small frames: merge branches and options, keys, dedupe, checks."""

import pytest
from pyspark.sql import functions as F

from snapflow.operators import checks, dedupe, keys, merge as M
from snapflow.schemas import SchemaError, enforce_schema, CUSTOMER_TYPED

SPEC = M.spec("k", ["k", "a", "b", "first"], ["a", "b"])


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, a string, b int, first string")


def _merge(spark, t, s, ms=SPEC, as_of="2024-01-01 00:00:00"):
    return {r["k"]: r for r in M.snapshot_merge(t, s, ms, as_of, with_action=True).collect()}


def test_merge_branches_and_invariants(spark):
    s1 = _df(spark, [("1", "x", 1, "m1"), ("2", "y", None, "m1"), ("3", "z", 3, "m1")])
    t1 = M.snapshot_merge(M.empty_target(spark, SPEC, s1.schema), s1, SPEC, "2024-01-01 00:00:00")
    s2 = _df(spark, [("1", "x", 1, "m2"), ("2", "y", 5, "m2"), ("4", "w", 4, "m2"),
                     ("3", "q", 3, "m2")])
    r = _merge(spark, t1, s2)
    assert r["1"]["merge_action"] == "unchanged" and r["1"]["first"] == "m1"
    assert r["2"]["merge_action"] == "unchanged"          # NULL -> 5 is not a change (Q13)
    assert r["3"]["merge_action"] == "update" and r["3"]["first"] == "m1"   # insert-only (M5)
    assert r["4"]["merge_action"] == "insert" and r["4"]["CountOfFiles"] == 1
    ns = M.spec("k", ["k", "a", "b", "first"], ["a", "b"], null_safe=True)
    assert _merge(spark, t1, s2, ns)["2"]["merge_action"] == "update"
    # same snapshot twice: second run has no updates
    t2 = M.snapshot_merge(t1, s2, SPEC, "2024-02-01 00:00:00")
    again = _merge(spark, t2, s2, as_of="2024-03-01 00:00:00")
    assert {v["merge_action"] for v in again.values()} == {"unchanged"}


def test_drop_and_reactivate(spark):
    s1 = _df(spark, [("1", "x", 1, "m1"), ("2", "y", 2, "m1")])
    t1 = M.snapshot_merge(M.empty_target(spark, SPEC, s1.schema), s1, SPEC, "2024-01-01 00:00:00")
    s2 = _df(spark, [("1", "x", 1, "m2")])
    t2 = M.snapshot_merge(t1, s2, SPEC, "2024-02-01 00:00:00")
    t3 = M.snapshot_merge(t2, s2, SPEC, "2024-03-01 00:00:00")
    r3 = {r["k"]: r for r in t3.collect()}
    assert r3["2"]["Status"] == "Inactive" and str(r3["2"]["DropDate"]) == "2024-02-01 00:00:00"
    parity = M.spec("k", ["k", "a", "b", "first"], ["a", "b"], restamp_drops=True,
                    reactivate=False)
    p3 = {r["k"]: r for r in M.snapshot_merge(t2, s2, parity, "2024-03-01 00:00:00").collect()}
    assert str(p3["2"]["DropDate"]) == "2024-03-01 00:00:00"      # Q12 parity
    t4 = {r["k"]: r for r in M.snapshot_merge(t3, s1, SPEC, "2024-04-01 00:00:00").collect()}
    assert t4["2"]["Status"] == "Active" and t4["2"]["DropDate"] is None   # Q11
    p4 = {r["k"]: r for r in M.snapshot_merge(t3, s1, parity, "2024-04-01 00:00:00").collect()}
    assert p4["2"]["Status"] == "Inactive"                        # Q11 parity


def test_guard_keys(spark):
    with pytest.raises(checks.DataCheckError, match="duplicate"):
        checks.guard_keys(_df(spark, [("1", "x", 1, ""), ("1", "y", 1, "")]), "k")
    with pytest.raises(checks.DataCheckError, match="NULL"):
        checks.guard_keys(_df(spark, [(None, "x", 1, "")]), "k")


def test_dense_index_numeric_and_text(spark):
    df = spark.range(0, 1000).withColumn("s", F.format_string("k%04d", "id"))
    a = [r["i"] for r in keys.dense_index(df, "id", "i", 5, 7)
                         .orderBy("id").collect()]
    assert a == list(range(5, 1005))
    b = sorted(r["i"] for r in keys.dense_index(df, "s", "i", 1, 7).collect())
    assert b == list(range(1, 1001))


def test_dense_index_is_the_rank_whatever_the_settings(spark):
    """Ids of text keys follow key order and depend on neither ranges nor shuffle partitions."""
    df = spark.createDataFrame([(f"k{i * 37 % 101}",) for i in range(101)], "k string")
    want = {k: i for i, k in enumerate(sorted(r["k"] for r in df.collect()), 1)}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, ranges in (("8", None), ("5", None), ("8", 3)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert {r["k"]: r["i"] for r in keys.dense_index(df, "k", "i", 1, ranges).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_count_over_matches_window(spark):
    df = spark.createDataFrame([("A", None), ("a", None), ("b", 1), (None, None)], "n string, z int")
    parts = {"n": F.lower("n"), "z": F.col("z")}
    got = sorted(str(tuple(r)) for r in keys.count_over(df, parts, "c").collect())
    exp = sorted(str(tuple(r)) for r in keys.count_over_window(df, parts, "c").collect())
    assert got == exp


def _scans(df, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_count_over_spares_the_hot_group(spark, tmp):
    """A group of a third of all rows is counted exactly and joined by broadcast; the input is read once."""
    from pyspark.sql import functions as F
    spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 400).alias("k"), "id") \
        .write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    out = keys.count_over(df, {"k": F.col("k")}, "c", heavy_share=10)
    plan = _scans(out, spark)
    assert f"{tmp}/t" not in plan                      # what is left reads the copy, not the input
    assert "BroadcastHashJoin" in plan
    got = {(r["id"], r["k"]): r["c"] for r in out.collect()}
    want = {(r["id"], r["k"]): r["c"] for r in keys.count_over_window(df, {"k": F.col("k")}, "c").collect()}
    assert got == want and max(got.values()) == 1000


def test_top1_reads_its_input_once(spark, tmp):
    spark.createDataFrame([(i % 7 or None, i) for i in range(50)], "k long, v long").write.parquet(f"{tmp}/t")
    plan = _scans(dedupe.top1_per_key(spark.read.parquet(f"{tmp}/t"), "k", ["v"]), spark)
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan
    got = sorted((r["k"] is None, r["k"] or 0, r["v"]) for r in dedupe.top1_per_key(spark.read.parquet(f"{tmp}/t"), "k", ["v"]).collect())
    assert got == [(False, i, i) for i in range(1, 7)] + [(True, 0, 7 * i) for i in range(8)]


def test_contents_tell_swapped_values(spark, tmp):
    """Counts agree, two rows swap a value, a NULL moves to the next column, a row is doubled for another."""
    import pytest
    from snapflow.operators import checks, sinks
    rows = [(1, "a", None, [1.0]), (2, "b", "x", None), (2, "b", "x", None), (3, None, "c", [])]
    schema = "i int, s string, t string, v array<double>"
    noted, found = sinks.rebuild_reconciled(spark.createDataFrame(rows, schema).repartition(3), f"{tmp}/s")
    assert noted == found and noted.rows == 4
    checks.reconcile_contents(noted, found)
    assert checks.contents(spark.createDataFrame(rows[::-1], schema)) == noted
    for other in ([(1, "b", None, [1.0]), (2, "a", "x", None), *rows[2:]], [(1, None, "a", [1.0]), *rows[1:]],
                  [rows[0], rows[1], rows[0], rows[3]], [*rows[:3], (3, None, "c", None)]):
        spark.createDataFrame(other, schema).write.mode("overwrite").parquet(f"{tmp}/s")
        with pytest.raises(checks.DataCheckError, match="contents differ"):
            checks.reconcile_contents(noted, checks.contents(spark.read.parquet(f"{tmp}/s")))
    empty = checks.contents(spark.createDataFrame([], schema))
    assert empty.rows == 0 and empty == checks.contents(spark.createDataFrame([], schema))


def test_type_lattice(spark):
    """The least type that holds all values; a value that does not fit an earlier feed's types is an error."""
    import pytest
    from snapflow.operators import clean
    cases = {"int": ["1", " -7 ", "+3", "", None], "bigint": ["1", "9999999999"], "decimal(38,2)": ["1", "2.5", "-3.25"],
             "decimal(38,0)": ["1", "9" * 25], "double": ["1.5", "2e3", "7"], "date": ["2024-01-31", "1/2/2024", ""],
             "string": ["01", "2"], "string ": ["2024-01-31", "5"], "string  ": ["x", "1"], "string   ": ["", None], "string    ": ["nan", "1"],
             "string     ": ["2024-02-31"], "string      ": ["1d"], "string       ": ["0.5", "00.5"], "double ": ["1" * 30 + ".5", "0." + "1" * 20]}
    for want, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values], "c string")
        assert clean.inferred_types(df) == {"c": want.strip()}, values
    df = spark.createDataFrame([(" 1", "2.50", "01", "2024-1-5", ""), ("", "1", "x", "", None)], "a string, b string, c string, d string, e string")
    out = clean.coerced(df)
    assert [t for _, t in out.dtypes] == ["int", "decimal(38,2)", "string", "date", "string"]
    assert [tuple(str(x) for x in r) for r in out.collect()] == [("1", "2.50", "01", "2024-01-05", ""), ("None", "1.00", "x", "None", "None")]
    with pytest.raises(Exception):
        clean.coerced(spark.createDataFrame([("x",)], "a string"), types={"a": "int"}).collect()


def test_top1_keyless(spark):
    df = spark.createDataFrame([("1", "0", "a"), ("1", "1", "b"), (None, "1", "c"),
                                ("nan", "1", "d"), ("", "0", "e")], "k string, f string, id string")
    keep = sorted(r["id"] for r in dedupe.top1_per_key(df, "k", ["-f", "id"]).collect())
    assert keep == ["b", "c", "d", "e"]
    col = sorted(r["id"] for r in dedupe.top1_per_key(df, "k", ["-f", "id"], "collapse").collect())
    assert len(col) == 4 and "b" in col


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", "n", "2", "3.456", "S", "extra")],
                               "c_custkey string, c_name string, c_nationkey string, "
                               "c_acctbal string, c_mktsegment string, bogus string")
    with pytest.raises(SchemaError):
        enforce_schema(df, CUSTOMER_TYPED)
    out = enforce_schema(df.drop("bogus"), CUSTOMER_TYPED).first()
    assert out["c_custkey"] == 1 and str(out["c_acctbal"]) == "3.46"
    with pytest.raises(Exception):
        enforce_schema(df.drop("bogus").withColumn("c_custkey", F.lit(None).cast("string")),
                       CUSTOMER_TYPED).collect()


def test_collated_keys_and_changes(spark):
    """§1.4: under UTF8_LCASE_RTRIM 'ab' and 'AB ' are one key, and re-cased or blank-padded
    text is not a change; binary comparison sees a new key and a change."""
    ms = M.spec("k", ["k", "a"], ["a"], collation="UTF8_LCASE_RTRIM")
    binary = M.spec("k", ["k", "a"], ["a"])
    s1 = spark.createDataFrame([("ab", "x"), ("cd", "y")], "k string, a string")
    s2 = spark.createDataFrame([("AB ", "X  "), ("cd", "z")], "k string, a string")
    for spec, exp in ((ms, {"ab": "unchanged", "cd": "update"}),
                      (binary, {"ab": "drop", "AB ": "insert", "cd": "update"})):
        t1 = M.snapshot_merge(M.empty_target(spark, spec, s1.schema), s1, spec, "2024-01-01")
        got = {r["k"]: r["merge_action"]
               for r in M.snapshot_merge(t1, s2, spec, "2024-02-01", with_action=True).collect()}
        assert got == exp
    dup = spark.createDataFrame([("ab", "x"), ("AB ", "y")], "k string, a string")
    checks.guard_keys(dup, "k")                                    # binary: two keys
    with pytest.raises(checks.DataCheckError, match="duplicate"):
        checks.guard_keys(dup, "k", collation="UTF8_LCASE_RTRIM")
    t = spark.createDataFrame([("ab", 10_000_000_000)], "k string, pk long")
    src = spark.createDataFrame([("AB ",), ("new",)], "k string")
    ids = {r["k"]: r["pk"] for r in keys.attach_surrogate(src, t.withColumnRenamed("pk", "pk"),
                                                          "k", "pk",
                                                          collation="UTF8_LCASE_RTRIM").collect()}
    assert ids == {"AB ": None, "new": 10_000_000_001}
