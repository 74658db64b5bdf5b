"""Newly landed snapshot files are merged one at a time, exactly once."""

import os
import time

from pyspark.sql import functions as F

from snapflow.operators import merge as M
from snapflow.operators.sinks import VersionedTable
from snapflow.schemas import all_string
from snapflow.streaming.arrival import merge_arrivals, snapshot_stream

COLS = ["k", "v"]
SPEC = M.spec("k", COLS + ["FileName"], ["v", "FileName"], compare_cols=["v"])


def _land(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("k|v\n" + "".join(f"{k}|{v}\n" for k, v in rows))
    time.sleep(0.05)


def test_each_file_once_in_order(spark, tmp):
    land = os.path.join(tmp, "land"); os.makedirs(land)
    ck, root = os.path.join(tmp, "ck"), os.path.join(tmp, "table")
    _land(land, "snap_1.txt", [("a", 1), ("b", 1)])
    _land(land, "snap_2.txt", [("a", 2), ("c", 1)])
    stream = snapshot_stream(spark, land, all_string(COLS), pattern="snap_*.txt")
    runs = iter(["2024-01-26 04:00:00", "2024-02-26 04:00:00", "2024-03-26 04:00:00"])
    q = merge_arrivals(spark, stream, root, SPEC, ck, as_of_fn=lambda e: next(runs))
    q.awaitTermination(120)
    t = {r["k"]: r for r in VersionedTable(spark, root).read().collect()}
    assert t["a"]["v"] == "2" and t["a"]["Status"] == "Active" and t["a"]["SubStatus"] == "Updated"
    assert t["b"]["SubStatus"] == "Dropped" and t["c"]["SubStatus"] == "New"
    assert VersionedTable(spark, root).current_version() == 2
    # restart: nothing new -> nothing merged again
    q = merge_arrivals(spark, snapshot_stream(spark, land, all_string(COLS), pattern="snap_*.txt"),
                       root, SPEC, ck, as_of_fn=lambda e: "2024-04-26 04:00:00")
    q.awaitTermination(120)
    assert VersionedTable(spark, root).current_version() == 2


def test_markers_merge_folders_once(spark, tmp):
    """A snapshot is a folder of several files, announced by a marker; replaying a merged
    snapshot (as after a failure before the batch commit) leaves the table unchanged."""
    from snapflow.streaming.arrival import announce, marker_stream, merge_announced
    from snapflow.sources.delimited import read_delimited, write_delimited

    def read_snap(sp, folder):
        return read_delimited(sp, folder, COLS, file_col=None).good

    markers, root, ck = (os.path.join(tmp, n) for n in ("markers", "table", "ck"))
    snaps = [("s1", [("a", "1"), ("b", "1"), ("c", "1")], "2024-01-26 04:00:00"),
             ("s2", [("a", "2"), ("c", "1"), ("d", "1")], "2024-02-26 04:00:00")]
    spec = M.spec("k", COLS, ["v"])
    for name, rows, as_of in snaps:
        df = spark.createDataFrame(rows, "k string, v string").repartition(3)
        write_delimited(df, os.path.join(tmp, name))
        announce(spark, markers, name, os.path.join(tmp, name), as_of)
    q = merge_announced(spark, marker_stream(spark, markers), root, spec, ck, read_snap)
    q.awaitTermination(180)
    table = VersionedTable(spark, root)
    t = {r["k"]: r for r in table.read().collect()}
    assert table.current_version() == 2
    assert (t["a"]["v"], t["a"]["SubStatus"]) == ("2", "Updated")
    assert t["b"]["SubStatus"] == "Dropped" and t["d"]["SubStatus"] == "New"
    assert t["c"]["SubStatus"] == "New" and t["c"]["CountOfFiles"] == 1
    before = sorted(map(tuple, table.read().collect()))
    # restart: no new marker -> no new version
    q = merge_announced(spark, marker_stream(spark, markers), root, spec, ck, read_snap)
    q.awaitTermination(180)
    assert table.current_version() == 2
    # replay of the last snapshot with its own run time: a new version with identical rows
    M.merge_into_table(spark, table, read_snap(spark, os.path.join(tmp, "s2")), spec,
                       snaps[1][2])
    assert sorted(map(tuple, table.read().collect())) == before


def test_long_line_is_never_cut(spark, tmp):
    """A surplus field goes to the quarantine, or fails the batch; a quoted separator is text."""
    import pytest
    land = os.path.join(tmp, "land"); os.makedirs(land)
    _land(land, "snap_1.txt", [("a", 1), ("b", "1|2"), ("c", '"x|y"')])
    stream = lambda: snapshot_stream(spark, land, all_string(COLS), pattern="snap_*.txt")
    q = merge_arrivals(spark, stream(), os.path.join(tmp, "t1"), SPEC, os.path.join(tmp, "ck1"),
                       as_of_fn=lambda e: "2024-01-26 04:00:00", quarantine=os.path.join(tmp, "bad"))
    q.awaitTermination(120)
    t = {r["k"]: r["v"] for r in VersionedTable(spark, os.path.join(tmp, "t1")).read().collect()}
    assert t == {"a": "1", "c": "x|y"}
    assert [r["line"] for r in spark.read.parquet(os.path.join(tmp, "bad")).collect()] == ["b|1|2"]
    q = merge_arrivals(spark, stream(), os.path.join(tmp, "t2"), SPEC, os.path.join(tmp, "ck2"),
                       as_of_fn=lambda e: "2024-01-26 04:00:00")
    with pytest.raises(Exception, match="surplus"):
        q.awaitTermination(120)


def test_open_quote_fails_the_batch(spark, tmp):
    """The line after an open quote belongs to its record, so nothing of the file is loaded."""
    import pytest
    land = os.path.join(tmp, "land"); os.makedirs(land)
    _land(land, "snap_1.txt", [("a", 1), ("b", '"2'), ('c"', 3)])
    q = merge_arrivals(spark, snapshot_stream(spark, land, all_string(COLS), pattern="snap_*.txt"), os.path.join(tmp, "t"), SPEC,
                       os.path.join(tmp, "ck"), as_of_fn=lambda e: "2024-01-26 04:00:00", quarantine=os.path.join(tmp, "bad"))
    with pytest.raises(Exception, match="inside quotes"):
        q.awaitTermination(120)
    assert VersionedTable(spark, os.path.join(tmp, "t")).read() is None


def test_header_in_another_order_fails(spark, tmp):
    import pytest
    land = os.path.join(tmp, "land"); os.makedirs(land)
    with open(os.path.join(land, "snap_1.txt"), "w") as fh:
        fh.write("v|k\n1|a\n")
    q = merge_arrivals(spark, snapshot_stream(spark, land, all_string(COLS), pattern="snap_*.txt"),
                       os.path.join(tmp, "t"), SPEC, os.path.join(tmp, "ck"),
                       as_of_fn=lambda e: "2024-01-26 04:00:00")
    with pytest.raises(Exception, match="another order"):
        q.awaitTermination(120)


def test_late_repeated_and_corrected_deliveries(spark, tmp):
    """Decisions by keyed state, also over a restart; an old month lands in the side folder, not in the master."""
    from snapflow.streaming.arrival import marker_stream
    from snapflow.streaming.deliveries import announce_delivery, merge_deliveries

    def read_snap(sp, folder):
        return sp.read.parquet(folder)

    markers, root, late, log = (os.path.join(tmp, n) for n in ("markers", "table", "late", "log"))
    rows = {"jan": [("a", "1"), ("b", "1")], "mar": [("a", "3"), ("c", "3")], "feb": [("a", "2"), ("b", "2")], "fix": [("a", "4"), ("c", "3")]}
    for name, r in rows.items():
        spark.createDataFrame(r, "k string, v string").write.parquet(os.path.join(tmp, name))
    spec, month = M.spec("k", COLS, ["v"]), "2024-{:02d}-26 04:00:00".format

    def deliver(*names_months):
        for name, folder, m in names_months:
            announce_delivery(spark, markers, name, os.path.join(tmp, folder), month(m), "members", read_snap)
        q = merge_deliveries(spark, marker_stream(spark, markers), root, spec, os.path.join(tmp, "ck"), read_snap, late, log)
        q.awaitTermination(240)
        assert q.exception() is None

    deliver(("1", "jan", 1), ("2", "mar", 3))
    first = sorted(map(tuple, VersionedTable(spark, root).read().collect()))
    deliver(("3", "feb", 2), ("4", "mar", 3), ("5", "feb", 2))               # a new query: the state comes from the checkpoint
    assert sorted(map(tuple, VersionedTable(spark, root).read().collect())) == first
    deliver(("6", "fix", 3))                                                # the newest month again, corrected
    t = {r["k"]: (r["v"], r["SubStatus"]) for r in VersionedTable(spark, root).read().collect()}
    assert t == {"a": ("4", "Updated"), "b": ("1", "Dropped"), "c": ("3", "New")}
    acted = {r["marker"]: r["action"] for r in spark.read.parquet(log).collect()}
    assert acted == {"1.ready": "merge", "2.ready": "merge", "3.ready": "older", "4.ready": "repeated", "5.ready": "repeated", "6.ready": "merge"}
    assert sorted(map(tuple, spark.read.parquet(f"{late}/3.ready").collect())) == rows["feb"]
    assert os.listdir(late) == ["3.ready"]
