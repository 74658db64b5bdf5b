"""Streaming query over the driver's tables.

The two monthly customer snapshots (``plans.snapshots``) are landed as delimited folders under
the shared scratch folder and announced by marker files; a Structured Streaming query merges
each announced snapshot once, in order, into a versioned table.  The table it leaves equals the
batch ``snapshot_merge`` result, so the same oracle SQL checks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapflow.plans import snapshots as S
from snapflow.operators.sinks import VersionedTable
from snapflow.session import scratch_dir
from snapflow.sources.delimited import read_delimited, write_delimited
from snapflow.streaming.arrival import announce, marker_stream, merge_announced


def _typed_snapshot(types: dict[str, str]):
    def read(spark: SparkSession, folder: str) -> DataFrame:
        g = read_delimited(spark, folder, S.SNAPSHOT_COLS, sep="|", blank_as_null=True,
                           file_col=None).good
        return g.select([F.col(c).cast(types[c]).alias(c) for c in S.SNAPSHOT_COLS])
    return read


def q_stream_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots land one after the other; each is merged exactly once, in arrival order."""
    root = scratch_dir(spark, "arrival")
    s1, s2 = S.snapshots(spark, sf_dir)
    types = {f.name: f.dataType.simpleString() for f in s1.schema.fields}
    markers = f"{root}/markers"
    for name, snap, as_of in (("snap_1", s1, S.AS_OF_1), ("snap_2", s2, S.AS_OF_2)):
        write_delimited(snap, f"{root}/landing/{name}", sep="|")
        announce(spark, markers, name, f"{root}/landing/{name}", as_of)
    q = merge_announced(spark, marker_stream(spark, markers), f"{root}/table",
                        S.customer_spec(), f"{root}/checkpoint", _typed_snapshot(types))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"arrival stream failed: {q.exception()}")
    return VersionedTable(spark, f"{root}/table").read()


# order of arrival -> deliveries: (name, snapshot number or none for an old month, month)
_ARRIVALS = {
    "in order": [("a", 1, S.AS_OF_1), ("b", 2, S.AS_OF_2)],
    "repeated": [("a", 1, S.AS_OF_1), ("a2", 1, S.AS_OF_1), ("b", 2, S.AS_OF_2), ("b2", 2, S.AS_OF_2), ("a3", 1, S.AS_OF_1)],
    "older last": [("a", 1, S.AS_OF_1), ("b", 2, S.AS_OF_2), ("old", 2, "1997-12-01 04:00:00"), ("old2", 2, "1997-12-01 04:00:00")],
}


def q_stream_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two monthly snapshots in three orders of arrival, with deliveries repeated and an old
    month after a newer one; each order leaves the same table."""
    from snapflow.streaming.deliveries import announce_delivery, merge_deliveries
    root = scratch_dir(spark, "deliveries")
    snaps = S.snapshots(spark, sf_dir)
    types = {f.name: f.dataType.simpleString() for f in snaps[0].schema.fields}
    for n, snap in enumerate(snaps, 1):
        write_delimited(snap, f"{root}/landing/snap_{n}", sep="|")
    tables = []
    for order, arrivals in _ARRIVALS.items():
        base = f"{root}/{order.replace(' ', '_')}"
        for name, n, as_of in arrivals:
            announce_delivery(spark, f"{base}/markers", name, f"{root}/landing/snap_{n}", as_of, "customers", _typed_snapshot(types))
        q = merge_deliveries(spark, marker_stream(spark, f"{base}/markers"), f"{base}/table", S.customer_spec(), f"{base}/checkpoint",
                             _typed_snapshot(types), f"{base}/late", f"{base}/log")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"delivery stream failed: {q.exception()}")
        tables.append(VersionedTable(spark, f"{base}/table").read().select(F.lit(order).alias("arrival"), "*"))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])
