"""Versioned tables: bucketed layout (K6) keeps the accumulated table out of the merge shuffle."""

import os

import pytest
from snapflow.operators import merge as M
from snapflow.operators.sinks import VersionedTable

SPEC = M.spec("k", ["k", "v"], ["v"])


def _snap(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_bucketed_target_is_not_reshuffled(spark, tmp):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    s1 = _snap(spark, [(i, "a") for i in range(200)])
    s2 = _snap(spark, [(i, "b" if i % 3 == 0 else "a") for i in range(50, 260)])
    results = {}
    for buckets in (None, n):
        table = VersionedTable(spark, os.path.join(tmp, f"t{buckets}"), buckets=buckets)
        M.merge_into_table(spark, table, s1, SPEC, "2024-01-26 04:00:00")
        prev = VersionedTable(spark, table.root).read()       # layout comes from _LAYOUT
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            shuffles = _exchanges(M.snapshot_merge(prev, s2, SPEC, "2024-02-26 04:00:00"))
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert shuffles == (2 if buckets is None else 1)
        m = M.merge_into_table(spark, table, s2, SPEC, "2024-02-26 04:00:00")
        assert m["insert"] == 60 and m["drop"] == 50
        results[buckets] = sorted(map(tuple, table.read().collect()))
    assert results[None] == results[n]


def test_bucketed_snapshot_copy_needs_no_exchange(spark, tmp):
    """The snapshot copy written bucketed like the target: the merge join and the key guard's
    aggregate run without any shuffle."""
    from snapflow.operators import checks
    from snapflow.session import materialize
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = VersionedTable(spark, os.path.join(tmp, "t"), buckets=n)
    M.merge_into_table(spark, table, _snap(spark, [(i, "a") for i in range(100)]), SPEC,
                       "2024-01-26 04:00:00")
    src = materialize(_snap(spark, [(i, "b") for i in range(50, 150)]), "snap",
                      bucket_by=(["k"], n))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _exchanges(M.snapshot_merge(table.read(), src, SPEC, "2024-02-26 04:00:00")) == 0
        assert _exchanges(checks.key_violations(src, "k")) == 0
        # the post-write audit reads the version through its bucketed definition
        written = table.read_version(table.current_version())
        assert _exchanges(checks.key_violations(written, "k")) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    m = M.merge_into_table(spark, table, src, SPEC, "2024-02-26 04:00:00")
    assert (m["insert"], m["update"], m["drop"]) == (50, 50, 50)


def test_merge_write_moves_no_row(spark, tmp):
    """The plans that are written: no exchange on either bucketed side, with and without new identities;
    same rows as the plain merge; at most two files a bucket however often the table is merged."""
    from pyspark.sql import functions as F
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spec = M.spec("k", ["k", "v"], ["v"], surrogate_col="pk", surrogate_start=1000)
    for ms in (SPEC, spec):
        table = VersionedTable(spark, os.path.join(tmp, f"w{ms.surrogate_col}"), buckets=n)
        plain = VersionedTable(spark, os.path.join(tmp, f"p{ms.surrogate_col}"))
        plans, orig = [], table._write_part

        def spy(df, *rest):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return orig(df, *rest)
        table._write_part = spy
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            for month, (lo, hi) in enumerate([(0, 300), (100, 400), (50, 350), (0, 500)], 1):
                snap = spark.range(lo, hi).select(F.col("id").alias("k"), F.concat(F.lit("v"), (F.col("id") % (month + 1)).cast("string")).alias("v"))
                plans.clear()
                got = M.merge_into_table(spark, table, snap, ms, f"2024-0{month}-26 04:00:00")
                want = M.merge_into_table(spark, plain, snap, ms, f"2024-0{month}-26 04:00:00")
                assert {k: v for k, v in got.items()} == {k: v for k, v in want.items()}
                assert len(plans) == (1 if month == 1 else 2)
                for plan in plans:                   # with identities only the issued ones move, to their keys
                    moved = plan.count("Exchange hashpartitioning")
                    assert moved == plan.count("ReusedExchange") + moved <= (1 if ms.surrogate_col else 0), plan
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, plain.read().collect()))
        files = [f for f in os.listdir(table.path_of(4)) if f.startswith("part-")]
        assert len(files) <= 2 * n


def test_identities_of_two_writers(spark, tmp):
    """Claims: consecutive, never the same for two writers, no scan once a claim exists."""
    from concurrent.futures import ThreadPoolExecutor
    root = os.path.join(tmp, "ids")
    os.makedirs(root)
    writers = [VersionedTable(spark, root) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        got = sorted(pool.map(lambda i: (writers[i % 4].claim_ids(i + 1, 100), i + 1), range(12)))
    ends = [100]
    for first, count in got:
        assert first == ends[-1]
        ends.append(first + count)
    def scanned():
        raise AssertionError("the table was scanned")
    assert writers[0].claim_ids(5, 100, scanned) == ends[-1] and writers[1].claim_ids(0, 100, scanned) == ends[-1] + 5
    old = VersionedTable(spark, os.path.join(tmp, "old"))
    os.makedirs(old.root)
    assert old.claim_ids(3, 100, lambda: 250) == 251 and old.claim_ids(1, 100, scanned) == 254


def test_of_writers_that_create_one_file_one_succeeds(spark, tmp):
    """Pointers and claims: in each of 200 rounds six writers create the same file at once."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier
    gate, root = Barrier(6), os.path.join(tmp, "race")

    def write(i):
        table, created = VersionedTable(spark, root), []
        for k in range(200):
            gate.wait(60)
            try:
                table._write_small(f"{root}/x.{k}", f"{i}" * (i + 1))
            except Exception:                    # noqa: BLE001 - the others' error
                continue
            created.append(k)
        return created
    with ThreadPoolExecutor(6) as pool:
        created = list(pool.map(write, range(6)))
    assert sorted(k for c in created for k in c) == list(range(200))
    for i, c in enumerate(created):
        assert all(VersionedTable(spark, root)._read_small(f"{root}/x.{k}") == f"{i}" * (i + 1) for k in c)


def test_snapshot_copy_released_after_publish(spark, tmp):
    """The merge's snapshot copy is deleted once the new version is published."""
    from snapflow import session
    table = VersionedTable(spark, os.path.join(tmp, "t"), buckets=4)
    made = []
    orig = session.materialize

    def spy(df, name, bucket_by=None):
        out = orig(df, name, bucket_by)
        made.append(out._snapflow_copy[0])
        return out
    session.materialize = spy
    try:
        M.merge_into_table(spark, table, _snap(spark, [(i, "a") for i in range(20)]), SPEC,
                           "2024-01-26 04:00:00")
    finally:
        session.materialize = orig
    assert len(made) == 1 and not os.path.exists(made[0].replace("file:", "", 1))
    assert table.read().count() == 20


def test_publish_never_loses_a_version(spark, tmp):
    a, b = (VersionedTable(spark, os.path.join(tmp, "p")) for _ in range(2))
    for n in (4, 6):
        v, _ = a.write_next(spark.range(n), "id")
        a.publish(v)
    # a writer that died before publishing: readers see the last version, the next writer stops
    a.write_next(spark.range(9), "id")
    assert b.read().count() == 6
    with pytest.raises(FileExistsError):
        b.write_next(spark.range(1), "id")
    assert b.drop_unpublished() == [3]
    v, _ = b.write_next(spark.range(7), "id")
    b.publish(v)
    with pytest.raises(Exception):           # the second of two writers of one version
        a.publish(v)
    assert a.read().count() == 7
    assert a.drop_versions(keep=1) == [1, 2] and a.read().count() == 7


def test_versions_without_pointer_are_not_an_empty_table(spark, tmp):
    t = VersionedTable(spark, os.path.join(tmp, "q"))
    t.write_next(spark.range(3), "id")
    with pytest.raises(RuntimeError):
        t.read()


def test_bucketed_write_has_one_file_a_bucket(spark, tmp):
    t = VersionedTable(spark, os.path.join(tmp, "b"), buckets=4)
    _, path = t.write_next(spark.range(0, 1000, 1, 16), "id")
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 4
