"""Deliveries that come late, twice or out of order.

The stream carries markers, one a delivered snapshot folder (``arrival``).  Keyed state holds, for
each feed, the newest month that was merged and what was delivered so far; it decides for every
marker, once, also after a restart:

    merge      a later month than any before, or the newest month with other contents (a correction)
    older      an earlier month: merging it would roll the master back, so its rows go to a side
               folder, one a delivery, for whoever corrects the history
    repeated   a month with contents that were delivered before: nothing is done

Contents are known by the order-free digest of ``checks.Contents``, which the announcer computes with
a distributed scan; the state holds one short text a delivery.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from snapflow.operators import checks, merge as M
from snapflow.operators.sinks import open_table
from snapflow.streaming.arrival import announce

DECISIONS = "feed string, marker string, as_of string, folder string, digest string, action string"
_STATE = "newest string, seen array<string>"


def digest_of(rows: DataFrame) -> str:
    c = checks.contents(rows)
    return "-".join(str(x) for x in (c.rows, *c.digest))


def announce_delivery(spark: SparkSession, marker_folder: str, name: str, folder: str, as_of: str, feed: str,
                      read_snapshot: Callable[[SparkSession, str], DataFrame]) -> None:
    """Land the marker of a complete snapshot folder, with its feed and the digest of its rows."""
    announce(spark, marker_folder, name, folder, f"{as_of}\t{feed}\t{digest_of(read_snapshot(spark, folder))}")


def decisions(markers: DataFrame) -> DataFrame:
    """One row a marker of ``marker_stream``, with the action that the feed's state asks for."""
    part = F.split("value", "\t")
    parsed = markers.where("value <> ''").select(
        part[2].alias("feed"), "marker", F.trim(part[1]).cast("timestamp_ntz").cast("string").alias("as_of"),
        part[0].alias("folder"), part[3].alias("digest"))

    def decide(key, frames, state: GroupState):
        import pandas as pd
        newest, seen = state.get if state.exists else ("", [])
        seen = list(seen)
        rows = pd.concat(list(frames)).sort_values(["as_of", "marker"])
        actions = []
        for as_of, digest in zip(rows["as_of"], rows["digest"]):
            known = f"{as_of} {digest}"
            if known in seen:
                actions.append("repeated")
                continue
            seen.append(known)
            actions.append("merge" if as_of >= newest else "older")
            newest = max(newest, as_of)
        state.update((newest, seen))
        yield rows.assign(feed=key[0], action=actions)[["feed", "marker", "as_of", "folder", "digest", "action"]]

    return parsed.groupBy("feed").applyInPandasWithState(decide, DECISIONS, _STATE, "append", GroupStateTimeout.NoTimeout)


def merge_deliveries(spark: SparkSession, markers: DataFrame, table_root: str, ms: M.MergeSpec, checkpoint: str,
                     read_snapshot: Callable[[SparkSession, str], DataFrame], late_folder: str, log_folder: str,
                     buckets: int | None = None):
    """Act on every decision: merge, set aside, or leave.  ``log_folder`` keeps the decisions, one
    subfolder a batch.  A batch that is run again after a failure decides alike, as its state is read
    from the batch before; a merge of the same snapshot with the same time changes nothing, and
    folders are overwritten."""
    table = open_table(spark, table_root, buckets)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        found = batch.collect()                          # a row a marker, one marker a batch
        for r in sorted(found, key=lambda r: (r["as_of"], r["marker"])):
            if r["action"] == "repeated":
                continue
            rows = read_snapshot(session, r["folder"])
            if r["action"] == "merge":
                M.merge_into_table(session, table, rows, ms, r["as_of"])
            else:
                rows.write.mode("overwrite").parquet(f"{late_folder.rstrip('/')}/{r['marker']}")
        if found:
            session.createDataFrame(found, DECISIONS).write.mode("overwrite").parquet(f"{log_folder.rstrip('/')}/batch={epoch}")

    return (decisions(markers).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
