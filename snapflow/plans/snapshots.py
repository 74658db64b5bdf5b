"""Rolling-window customer snapshots derived from the driver's ``orders`` / ``customer`` tables.

The reference's feeds are full snapshots of a rolling 12-month window, delivered monthly.
The same shape is derived here: a customer is in the snapshot ending at ``end`` when it placed
an order in ``[start, end)``; its attributes are its static columns plus three facts about that
window.  Two consecutive snapshots then exercise every merge branch (new, updated, unchanged,
dropped) on whole tables.

Plan: the date filter reaches the ``orders`` scan (``PushedFilters``), the window facts are a
hash aggregate on ``o_custkey`` (partial before the shuffle), and the join with ``customer`` is on
the same key, so the snapshot leaves hash-partitioned by customer key — the partitioning the
merge's full outer join needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapflow.operators import merge as M
from snapflow.session import materialize

# Fixed parameters of the two monthly runs used by the registered queries.
WINDOW_1 = ("1997-01-01", "1998-01-01")
WINDOW_2 = ("1997-07-01", "1998-07-01")
AS_OF_1 = "1998-01-01 04:00:00"
AS_OF_2 = "1998-07-01 04:00:00"

SNAPSHOT_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "best_priority",
                 "is_frequent", "open_priority", "snapshot_month"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_snapshot(customer: DataFrame, orders: DataFrame, start: str, end: str) -> DataFrame:
    o = orders.where((F.col("o_orderdate") >= F.lit(start).cast(T.TimestampNTZType()))
                     & (F.col("o_orderdate") < F.lit(end).cast(T.TimestampNTZType())))
    facts = o.groupBy("o_custkey").agg(
        F.min("o_orderpriority").alias("best_priority"),
        (F.count(F.lit(1)) >= 2).alias("is_frequent"),
        F.min(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))).alias("open_priority"),
    )
    snap = customer.join(facts, customer["c_custkey"] == facts["o_custkey"], "inner")
    month = end[:4] + end[5:7]
    return snap.select(*SNAPSHOT_COLS[:-1], F.lit(month).alias("snapshot_month"))


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = read(spark, sf_dir, "customer")
    orders = read(spark, sf_dir, "orders")
    return (customer_snapshot(customer, orders, *WINDOW_1),
            customer_snapshot(customer, orders, *WINDOW_2))


def customer_spec(**kw) -> M.MergeSpec:
    """Key ``c_custkey``; ``snapshot_month`` is insert-only (the month a customer first appeared)."""
    insert_only = kw.pop("insert_only", ("snapshot_month",))
    update = [c for c in SNAPSHOT_COLS if c != "c_custkey" and c not in insert_only]
    return M.spec("c_custkey", SNAPSHOT_COLS, update, **kw)


def two_runs(spark: SparkSession, sf_dir: str, ms: M.MergeSpec, with_action: bool = False,
             surrogate: bool = False) -> DataFrame:
    """Run 1 folds snapshot 1 into an empty table, run 2 folds snapshot 2 into the result."""
    s1, s2 = snapshots(spark, sf_dir)
    if surrogate:
        from snapflow.operators.keys import attach_surrogate
        s1 = attach_surrogate(s1, None, "c_custkey", ms.surrogate_col, ms.surrogate_start)
    empty = M.empty_target(spark, ms, s1.schema)
    t1 = M.snapshot_merge(empty, s1, ms, AS_OF_1)
    if surrogate:
        # M7: the first run's ids are needed to continue the sequence; cut lineage there
        t1 = materialize(t1, "surrogate_run1")
        s2 = attach_surrogate(s2, t1, "c_custkey", ms.surrogate_col, ms.surrogate_start)
    return M.snapshot_merge(t1, s2, ms, AS_OF_2, with_action=with_action)
