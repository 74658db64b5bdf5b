"""Hilbert-curve sharding: quantise metadata, order rows along the curve, cut the order into runs.

Neighbours on the curve are near in every dimension, so each shard covers a small box of the
metadata space and readers that filter on any of the dimensions skip most shards.

Law ``rows``: the order is cut at equal row counts, so shard sizes differ by one row at most.

Defined results
    null metadata     its own place: below all numbers, one place for null categories
    null text         size 8, checksum of the empty text
    ties              equal places are ordered by text hash, then id: equal texts lie side by side
    repeated rows     each gets its own slot
    empty table       empty result
    extra columns     only the named ones are read
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from snapflow.llm.common import DOC_ID, materialize


@dataclass(frozen=True)
class Dimension:
    """A metadata column.  Numbers are quantised by quantile, categories by hash."""

    column: str
    numeric: bool = False


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Per state and orthant of a ``dims``-dimensional Hilbert curve: position and next state.

    A state is the corner where the curve enters a cell and the axis along which it leaves; inside
    the cell the 2^dims orthants follow the Gray code, rotated to that axis and reflected to that
    corner.
    """
    n, full = dims, (1 << dims) - 1

    def rotated(x: int, by: int) -> int:
        by %= n
        return ((x >> by) | (x << (n - by))) & full

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    rank = {gray(i): i for i in range(1 << n)}

    def flip_axis(i: int) -> int:           # axis along which the Gray code moves after step i
        return ((i + 1) & ~i).bit_length() - 1

    def entry(i: int) -> int:               # corner of the sub-cell where its own curve begins
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def axis(i: int) -> int:                # axis along which the sub-cell's curve leaves
        return 0 if i == 0 else (flip_axis(i) if i % 2 else flip_axis(i - 1)) % n

    place, after = [], []
    for state in range((1 << n) * n):
        corner, along = divmod(state, n)
        for orthant in range(1 << n):
            w = rank[rotated(orthant ^ corner, along + 1)]
            place.append(w)
            after.append((corner ^ rotated(entry(w), n - along - 1)) * n + (along + axis(w) + 1) % n)
    return place, after


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Curve index of integer coordinates of ``bits`` bits each: one table step per bit."""
    n = len(cells)
    place, after = curve_tables(n)

    def step(a: Column, level: Column) -> Column:
        orthant = F.lit(0)
        for j, c in enumerate(cells):
            bit = F.call_function("shiftright", c, level).bitwiseAND(F.lit(1))
            orthant = orthant + bit * (1 << j)
        at = a["state"] * (1 << n) + orthant
        return F.struct((a["index"] * (1 << n) + F.get(F.lit(place), at)).cast("long").alias("index"),
                        F.get(F.lit(after), at).cast("int").alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(levels, start, step, lambda a: a["index"])


def quantised(docs: DataFrame, dims: list[Dimension], bits: int) -> list[Column]:
    """Integer coordinate of each dimension; the quantile cuts are 2^bits - 1 numbers a dimension."""
    cells, top = [], (1 << bits) - 1
    numeric = [d.column for d in dims if d.numeric]
    probs = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = docs.agg(*[F.percentile_approx(docs[c].cast("double"), probs, 10000).alias(f"c{i}")
                      for i, c in enumerate(numeric)]).first() if numeric else ()
    for d in dims:
        col = docs[d.column]
        if d.numeric:
            limits = sorted(set(cuts[numeric.index(d.column)] or []))
            cells.append(F.coalesce(F.size(F.filter(F.lit(limits), lambda x, c=col: x <= c.cast("double"))),
                                    F.lit(0)) if limits else F.lit(0))
        else:
            cells.append(F.when(col.isNull(), F.lit(0))
                         .otherwise((F.pmod(F.xxhash64(col), F.lit(top)) + 1).cast("int")))
    return [F.greatest(F.lit(0), F.least(F.lit(top), c)).cast("int") for c in cells]


def hilbert_shards(docs: DataFrame, dims: list[Dimension], shards: int = 24, bits: int = 5,
                   id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve_index`` of every row.

    Only ids, checksums and curve places are shuffled, in one range exchange over (curve index,
    text hash, id): hot cells split at the id.  The sorted rows are kept as a shared table; their
    place within a partition plus the partition counts (one number a partition at the driver)
    give each row's exact rank.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    meta = docs.select(
        docs[id_col].alias(DOC_ID), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("__th"),
        hilbert_index(quantised(docs, dims, bits), bits).alias("curve_index"))
    order = ["curve_index", "__th", DOC_ID]
    ranked = materialize(meta.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("__pos", F.monotonically_increasing_id()), "hilbert")
    part = F.shiftright("__pos", 33).cast("int")
    counts = dict(ranked.groupBy(part.alias("p")).count().collect())
    total, before = 0, []
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    offsets = spark.createDataFrame(before, "__p int, __before long")
    rank = F.col("__before") + F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))
    n = max(total, 1)
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return (ranked.join(F.broadcast(offsets), part == F.col("__p"))
            .withColumn("__rank", rank)
            .withColumn("shard", F.expr(f"cast((__rank * {shards}L) div {n}L as int)"))
            .select(DOC_ID, "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("__rank") - first).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "curve_index"))
