"""Keys: person hash key (X15-X17), lines-of-business count (W2), surrogate identity (M7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def person_key(parts, lower_first: int = 2) -> Column:
    """Upper-case hex MD5 over a NULL-skipping concatenation (T-SQL CONCAT skips NULL,
    Spark ``concat`` does not, ``concat_ws('')`` does).  The first ``lower_first`` parts are
    lower-cased (names); dates render ISO ``yyyy-MM-dd`` through the string cast."""
    cols = []
    for i, p in enumerate(parts):
        c = _c(p).cast(T.StringType())
        cols.append(F.lower(c) if i < lower_first else c)
    return F.upper(F.md5(F.concat_ws("", *cols)))


def count_over(df: DataFrame, parts: dict[str, Column], out: str, heavy_share: int = 1000) -> DataFrame:
    """``COUNT(*) OVER (PARTITION BY parts)`` without funnelling a hot group into one task.

    A window would sort and buffer the whole group in one task.  Here the rows are written once to
    the shared folder with a hash of their group (128 bits; NULL parts form one group, as in the
    window), so the lineage before is computed once.  Groups are counted on that column alone
    (partial counts before the shuffle).  Groups of more than ``1 / heavy_share`` of all rows, so
    fewer than ``heavy_share``, get their count by a broadcast join and never move; the rest by a
    join on the hash.
    """
    from snapflow.session import materialize
    named = [x for n, e in parts.items() for x in (e.isNull(), F.coalesce(e.cast(T.StringType()), F.lit("")))]
    text = F.concat_ws("\x1f", *[F.concat(F.length(x.cast(T.StringType())).cast(T.StringType()), F.lit(":"), x.cast(T.StringType()))
                                 for x in named])
    rows = materialize(df.withColumn("_g", F.md5(text)), "counted")
    counts = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    limit = rows.count() // heavy_share
    heavy = F.broadcast(counts.where(F.col("_n") > limit).select("_g", "_n")) if limit else counts.where("false")
    rest = rows.join(heavy.select("_g"), "_g", "left_anti").join(counts, "_g")
    found = rest.unionByName(rows.join(heavy, "_g")) if limit else rows.join(counts, "_g")
    return found.withColumn(out, F.col("_n").cast(T.IntegerType())).drop("_g", "_n")


def count_over_window(df: DataFrame, parts: dict[str, Column], out: str) -> DataFrame:
    """The literal window form, kept for comparison in tests."""
    w = Window.partitionBy(*parts.values())
    return df.withColumn(out, F.count(F.lit(1)).over(w).cast(T.IntegerType()))


def dense_index(df: DataFrame, order_col: str, out: str, start=1, num_buckets: int | None = None) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` in key order, with no single-partition window (M7).

    Rows are range-partitioned by the key (numbers and text alike), sorted, and written once with
    their range and place in it, so that a lost executor cannot draw the ranges anew; nothing is
    shuffled a second time.  Counts a range (one row each, a bounded table) give each range's
    offset.  The id is the key's rank: it depends on no setting, neither on the number of ranges
    (``num_buckets``, default the shuffle partitions).  ``order_col`` should be unique (a merge key
    after ``guard_keys``).  ``start`` may be a function that takes the number of rows and gives the
    first id (``VersionedTable.claim_ids``).
    """
    from snapflow.session import materialize
    n = [] if num_buckets is None else [num_buckets]
    ranged = df.repartitionByRange(*n, F.col(order_col)).sortWithinPartitions(order_col)
    # partition number in the upper bits, place in the partition in the lower 33
    b = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "key_ranges")
    counts = b.groupBy(F.shiftright("_at", 33).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    if callable(start):
        start = start(b.count())
    # one row a range: the running total over this tiny table is cheap in one task
    offsets = counts.select(
        "_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_off"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (b.join(F.broadcast(offsets), F.shiftright("_at", 33) == F.col("_b"))
            .withColumn(out, (F.lit(start) + F.col("_off") + place).cast(T.LongType())).drop("_at", "_b", "_off"))


def attach_surrogate(source: DataFrame, target: DataFrame | None, key: str, col: str,
                     start: int = 10_000_000_000, num_buckets: int | None = None,
                     collation: str | None = None, claim=None) -> DataFrame:
    """M7 before a merge: keys of ``source`` absent from ``target`` get the next identity values;
    keys already in the target get NULL here and keep their issued value in the merge.  The values
    start at ``claim(number of new keys)`` (a table's high-water mark, no scan), without ``claim``
    at ``max(target.col) + 1``.  Only key columns are shuffled for the anti join; the final left
    join is on the merge key, so its partitioning is reused by the merge's join.
    ``collation`` matches text keys as the merge does."""
    base = start
    if target is not None:
        if claim is None:
            mx = target.agg(F.max(col).alias("m")).first()["m"]
            if mx is not None:
                base = max(start, mx + 1)
        sk, tk = source.select(key), target.select(F.col(key).alias("_tk"))
        if collation and isinstance(source.schema[key].dataType, T.StringType):
            cond = F.collate(sk[key], collation) == F.collate(tk["_tk"], collation)
        else:
            cond = sk[key] == tk["_tk"]
        new_keys = sk.join(tk, cond, "left_anti")
    else:
        new_keys = source.select(key)
    issued = dense_index(new_keys, key, col, start=claim or base, num_buckets=num_buckets)
    return source.join(issued, key, "left")
