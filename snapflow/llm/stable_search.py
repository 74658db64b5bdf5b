"""Approximate nearest neighbours: stable projections, a kd-tree over them, a chi-square stopping test.

Nearness is the inner product.  Every vector gets one more coordinate that makes all lengths equal, and
queries are scaled to that length, so the largest product is the smallest distance.  Gaussian (2-stable)
projections to ``dims`` numbers keep distances up to a chi-square factor: the squared distance of two
projections, over that of the vectors, has the chi-square law of ``dims`` degrees.  A kd-tree over the
projections yields candidates nearest first; a candidate's true product is computed (verified), and a
query stops once the next projected distance is so great, against its worst accepted neighbour, that a
better neighbour would lie there with probability below ``1 - sure``.

On Spark: the top of the tree, fitted on a bounded sample, deals all vectors to cells; a task holds one
cell (or a slab of it) with the rest of the tree and streams its queries through.  Each query searches
its own cell first; what it finds there bounds the radius of the stopping test, and only cells whose box
reaches into that radius see it again.  Equal vectors are one point that carries its ``k + 1`` smallest
ids: no answer can hold more of them, so copies, however many, add no work.

Defined results
    unusable row         null or zero vector, null, non-finite or huge (1e150 and more) entry, or a length
                         other than the most frequent one: neither query nor candidate
    null id              a candidate, reported as null, after every id of equal score; never a query
    repeated rows        rows of equal id and vector count once
    repeated id          with other vectors: each row a query and a candidate of its own
    ties                 smaller id first
    fewer than k others  all of them
    empty table          empty result
    extra columns        only id and vector are read
"""

from __future__ import annotations

from dataclasses import dataclass
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapflow.llm.common import materialize
from snapflow.llm.vectors import matrix, usable

LIMIT = 1e150
MAX_CELLS = 4096


@dataclass(frozen=True)
class SearchPlan:
    """How to search; ``sure`` alone bears on the result."""
    dims: int = 8                      # projections, an even number
    sure: float = 0.97                 # of the stopping test
    sample_rows: int = 50_000          # that the top of the tree is fitted on, about
    cell_rows: int = 65_536            # points a task holds
    query_rows: int = 65_536           # queries that share one copy of a cell
    leaf_rows: int = 256
    seed: int = 5


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees."""
    term = total = math.exp(-x / 2)
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - total


def chi_square_bound(share: float, degrees: int) -> float:
    low, high = 0.0, 10.0 * degrees + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < share else (low, mid)
    return high


# ---- the tree -------------------------------------------------------------------------------

@dataclass
class Top:
    """Perfect binary tree of splits over the projections; its leaves are the cells."""
    directions: np.ndarray             # dims x (d + 1) normal numbers
    longest: float                     # greatest length of a vector
    axes: np.ndarray                   # of the inner nodes, heap order
    cuts: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.axes) + 1

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of candidates: with the coordinate that makes all lengths equal."""
        more = np.sqrt(np.maximum(self.longest ** 2 - (vectors ** 2).sum(axis=1), 0.0))
        return vectors @ self.directions[:, :-1].T + more[:, None] * self.directions[:, -1]

    def scaled(self, queries: np.ndarray) -> np.ndarray:
        return queries * (self.longest / np.sqrt((queries ** 2).sum(axis=1)))[:, None]

    def project_queries(self, scaled: np.ndarray) -> np.ndarray:
        return scaled @ self.directions[:, :-1].T

    def cell(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        for _ in range(self.cells.bit_length() - 1):
            at = 2 * at + 1 + (points[np.arange(len(points)), self.axes[at]] > self.cuts[at])
        return at - len(self.axes)


def _fit_splits(points: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    axes, cuts = np.zeros(2 ** levels - 1, np.int64), np.zeros(2 ** levels - 1)
    parts = [points]
    for node in range(len(axes)):
        p = parts[node]
        if len(p):
            axes[node] = int(np.ptp(p, axis=0).argmax())
            cuts[node] = float(np.median(p[:, axes[node]]))
        right = p[:, axes[node]] > cuts[node]
        parts += [p[~right], p[right]]
        parts[node] = None
    return axes, cuts


def _away(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        x = points[:, j, None]
        gap = np.maximum(low[None, :, j] - x, x - high[None, :, j])
        out += np.maximum(gap, 0.0) ** 2
    return out


class Slab:
    """Points of one cell in memory, with the lower part of the tree."""

    def __init__(self, top: Top, plan: SearchPlan, vectors, keys, ids):
        self.top, self.plan = top, plan
        points = top.project(vectors)
        todo, leaves = [np.arange(len(vectors))], []
        while todo:
            at = todo.pop()
            if len(at) <= plan.leaf_rows:
                leaves.append(at)
                continue
            x = points[at]
            by = at[np.argpartition(x[:, int(np.ptp(x, axis=0).argmax())], len(at) // 2)]
            todo += [by[:len(at) // 2], by[len(at) // 2:]]
        order = np.concatenate(leaves)
        self.ends = np.cumsum([0, *map(len, leaves)])
        self.vectors, self.points = vectors[order], points[order]
        self.keys, self.ids = [keys[i] for i in order], [ids[i] for i in order]
        # order of points with equal products: by smallest id, those without id last
        first = np.array([x[0] if x[0] is not None else np.iinfo(np.int64).max for x in self.ids])
        self.turn = np.empty(len(first), np.int64)
        self.turn[np.argsort(first, kind="stable")] = np.arange(len(first))
        cut = self.ends[:-1]
        self.low = np.minimum.reduceat(self.points, cut, axis=0)
        self.high = np.maximum.reduceat(self.points, cut, axis=0)

    def search(self, queries: np.ndarray, bounds: np.ndarray, k: int):
        """(products, point numbers, squared distance of the k-th) of the k nearest found of each query.

        ``bounds``: squared distances that are known to hold k neighbours elsewhere."""
        top, n = self.top, len(queries)
        scaled = top.scaled(queries)
        at = top.project_queries(scaled)
        away = _away(at, self.low, self.high)
        factor = chi_square_bound(self.plan.sure, self.plan.dims)
        best = np.full((n, k), -np.inf)
        who = np.full((n, k), -1, np.int64)
        worst = bounds.copy()                             # squared distance that stops a query
        full = 2 * top.longest ** 2
        squares = (at ** 2).sum(axis=1)

        def visit(leaf: int, rows: np.ndarray) -> None:
            rows = rows[away[rows, leaf] <= worst[rows] * factor]
            if not len(rows):
                return
            a, b = self.ends[leaf], self.ends[leaf + 1]
            p = self.points[a:b]
            near = squares[rows][:, None] + (p ** 2).sum(axis=1) - 2 * (at[rows] @ p.T)
            reach = worst[rows] * factor
            product = scaled[rows] @ self.vectors[a:b].T                  # verification
            product[near > (reach * (1 + 1e-9) + 1e-9 * top.longest ** 2)[:, None]] = -np.inf
            better = np.flatnonzero(product.max(axis=1) >= best[rows, -1])
            better = better[product[better].max(axis=1) > -np.inf]
            if not len(better):
                return
            r = rows[better]
            values = np.concatenate([best[r], product[better]], axis=1)
            names = np.concatenate([who[r], np.broadcast_to(np.arange(a, b), (len(r), b - a))], axis=1)
            by = np.lexsort((np.where(names >= 0, self.turn[names], len(self.turn)), -values), axis=-1)[:, :k]
            best[r], who[r] = np.take_along_axis(values, by, 1), np.take_along_axis(names, by, 1)
            worst[r] = np.minimum(worst[r], np.maximum(full - 2 * best[r, -1], 0.0))

        nearest = away.argmin(axis=1)
        for leaf in np.unique(nearest):                   # each query's own leaf first
            visit(int(leaf), np.flatnonzero(nearest == leaf))
        for leaf in np.argsort(away.min(axis=0), kind="stable"):
            visit(int(leaf), np.flatnonzero(nearest != leaf))
        return best, who, worst


# ---- Spark ----------------------------------------------------------------------------------

_ENTRY = "array<struct<score: double, id: bigint, same: boolean>>"
_FOUND = f"h1 long, h2 long, worst double, entries {_ENTRY}"
_FOUND_TYPE = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("worst", pa.float64()),
                         ("entries", pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64()), ("same", pa.bool_())])))])


def _key() -> list[Column]:
    """128 bits that name a vector."""
    return [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), F.col("vector")).alias("h2")]


def _searching(shared, k: int):
    """Rows sorted by (cell, slab, block, kind): points of a slab, then its queries."""
    def run(batches):
        top, plan = shared.value
        held_key, held, slab = None, [], None

        def built():
            v = np.concatenate([x[0] for x in held])
            return Slab(top, plan, v, [y for x in held for y in x[1]], [y for x in held for y in x[2]])

        for batch in batches:
            where = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "slab", "block", "kind"))))
            cuts = [0, *[i for i in range(1, len(where)) if where[i] != where[i - 1]], len(where)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                *key, kind = where[lo]
                if key != held_key:
                    held_key, held, slab = key, [], None
                for at in range(lo, hi, 512):
                    part = batch.slice(at, min(512, hi - at))
                    vectors = matrix(part.column("vector"))
                    names = list(zip(part.column("h1").to_pylist(), part.column("h2").to_pylist()))
                    if kind == 0:
                        held.append((vectors, names, part.column("ids").to_pylist()))
                        continue
                    if not held and slab is None:
                        continue                          # a cell without points
                    if slab is None:
                        slab, held = built(), []
                    yield _answers(slab, vectors, names, part.column("bound").to_numpy(zero_copy_only=False), k)
    return run


def _answers(slab: Slab, vectors, names, bounds, k: int) -> pa.RecordBatch:
    _, who, worst = slab.search(vectors, bounds, k)
    entries = []
    for q, name, row in zip(vectors, names, who):
        row = row[row >= 0]
        scores = np.einsum("ij,j->i", slab.vectors[row], q)
        found = [(s, i, slab.keys[p] == name) for s, p in zip(scores.tolist(), row.tolist()) for i in slab.ids[p]]
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        entries.append([{"score": s, "id": i, "same": o} for s, i, o in found[:k]])
    return pa.RecordBatch.from_arrays([pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()),
                                       pa.array(worst), pa.array(entries, _FOUND_TYPE.field("entries").type)], schema=_FOUND_TYPE)


def _visited(points: DataFrame, sizes: dict[int, int], visits: DataFrame, shared, k: int, plan: SearchPlan) -> DataFrame:
    """Answers of the queries ``visits`` (``cell, h1, h2, vector, bound``) from the cells they visit."""
    spark = points.sparkSession
    asked = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}      # a row a cell
    shape = spark.createDataFrame(
        [(c, -(-n // plan.cell_rows), -(-asked[c] // plan.query_rows)) for c, n in sizes.items() if c in asked],
        "cell int, slabs int, blocks int")
    some = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    every = F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)).alias("slab")
    there = points.join(F.broadcast(shape), "cell").select(
        "cell", F.pmod("h2", F.col("slabs")).cast("int").alias("slab"), some, F.lit(0).alias("kind"), "h1", "h2", "vector", "ids",
        F.lit(None).cast("double").alias("bound"))
    here = visits.join(F.broadcast(shape), "cell").select(
        "cell", every, F.pmod("h1", F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("kind"), "h1", "h2", "vector",
        F.lit(None).cast("array<long>").alias("ids"), "bound")
    by = ["cell", "slab", "block"]
    rows = there.unionByName(here).repartition(*by).sortWithinPartitions(*by, "kind")
    return rows.mapInArrow(_searching(shared, k), _FOUND)


def _placed(shared, schema_ids: bool):
    def run(batches):
        top, _ = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("vector"))
            at = top.project(v) if schema_ids else top.project_queries(top.scaled(v))
            yield pa.RecordBatch.from_arrays([pa.array(top.cell(at).astype(np.int32)), *batch.columns],
                                             names=["cell", *batch.schema.names])
    return run


def _boxes(shared):
    def run(batches):
        top, _ = shared.value
        d = len(top.directions)
        low, high = np.full((top.cells, d), np.inf), np.full((top.cells, d), -np.inf)
        n = np.zeros(top.cells, np.int64)
        for batch in batches:
            if batch.num_rows:
                at, cell = top.project(matrix(batch.column("vector"))), batch.column("cell").to_numpy()
                np.minimum.at(low, cell, at)
                np.maximum.at(high, cell, at)
                n += np.bincount(cell, minlength=top.cells)
        c = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(n[c]), pa.array(low[c].tolist(), pa.list_(pa.float64())),
                                          pa.array(high[c].tolist(), pa.list_(pa.float64()))], names=["cell", "n", "low", "high"])
    return run


def _reaching(shared, boxes):
    """Cells, other than its own, whose box lies within a query's stopping radius."""
    def run(batches):
        top, plan = shared.value
        cells, low, high = boxes.value
        factor = chi_square_bound(plan.sure, plan.dims)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                at = top.project_queries(top.scaled(matrix(part.column("vector"))))
                reach = part.column("worst").to_numpy(zero_copy_only=False) * factor
                near = _away(at, low, high) <= (reach * (1 + 1e-9))[:, None]
                near &= cells[None, :] != part.column("cell").to_numpy()[:, None]
                q, c = np.nonzero(near)
                if len(q):
                    t = part.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells[c].astype(np.int32)), t.column("h1"), t.column("h2"), t.column("vector"), t.column("worst")],
                        names=["cell", "h1", "h2", "vector", "bound"])
    return run


def _fitted(points: DataFrame, n: int, plan: SearchPlan, d: int) -> Top:
    """The top of the tree, on about ``plan.sample_rows`` points (all, if there are fewer)."""
    longest = math.sqrt(points.agg(F.max("length2")).first()[0])
    directions = np.random.default_rng(plan.seed).standard_normal((plan.dims, d + 1))
    cells = max(-(-n // plan.cell_rows), min(16, n // 2048), 1)
    levels = min(MAX_CELLS, cells - 1).bit_length() if cells > 1 else 0
    top = Top(directions, longest, np.zeros(0, np.int64), np.zeros(0))
    if levels:
        share = min(1.0, plan.sample_rows / n)
        some = points.filter(F.pmod("h1", F.lit(1_000_003)) < F.lit(share * 1_000_003)).select("vector")

        def project(batches):
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(top.project(matrix(batch.column("vector"))).tolist(), pa.list_(pa.float64()))],
                                                     names=["at"])
        sample = np.array([r[0] for r in some.mapInArrow(project, "at array<double>").collect()])
        top.axes, top.cuts = _fit_splits(sample.reshape(-1, plan.dims), levels)
    return top


def nearest(table: DataFrame, asked: Column, k: int = 20, plan: SearchPlan = SearchPlan(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for every row for which
    ``asked`` (a condition on ``vec_id``) holds, among all other rows."""
    if plan.dims % 2:
        raise ValueError("the chi-square test takes an even number of projections")
    spark = table.sparkSession
    length2 = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = (usable(table, id_col, vector_col, LIMIT).withColumn("length2", length2).filter("length2 > 0")
            .select("vec_id", "vector", "length2", *_key()))
    # one point a distinct vector, with its k + 1 smallest ids; copies meet on the map side
    smallest = Window.partitionBy("h1", "h2").orderBy(F.col("vec_id").asc_nulls_last())
    ids = (rows.select("h1", "h2", "vec_id").distinct().withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= k + 1)
           .groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id"))).alias("l"))
           .select("h1", "h2", F.col("l.vec_id").alias("ids")))
    vectors = rows.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.first("length2").alias("length2"))
    points = materialize(vectors.join(ids, ["h1", "h2"]), "points")
    n = points.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    d = points.select(F.size("vector")).first()[0]
    top = _fitted(points, n, plan, d)
    shared = spark.sparkContext.broadcast((top, plan))          # splits: MAX_CELLS at most
    kind = points.schema["vector"].dataType.simpleString()
    placed = materialize(points.select("h1", "h2", "vector", "ids").mapInArrow(
        _placed(shared, True), f"cell int, h1 long, h2 long, vector {kind}, ids array<long>"), "cells")
    box = (placed.select("cell", "vector").mapInArrow(_boxes(shared), "cell int, n long, low array<double>, high array<double>")
           .groupBy("cell").agg(F.sum("n").alias("n"), *[F.min(F.col("low")[j]).alias(f"l{j}") for j in range(plan.dims)],
                                *[F.max(F.col("high")[j]).alias(f"u{j}") for j in range(plan.dims)]).orderBy("cell").collect())
    sizes = {r["cell"]: r["n"] for r in box}
    low, high = (np.array([[r[f"{s}{j}"] for j in range(plan.dims)] for r in box]) for s in "lu")
    boxes = spark.sparkContext.broadcast((np.array(list(sizes)), low, high))

    wanted = rows.filter(asked).select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    queries = (rows.filter(asked).groupBy("h1", "h2").agg(F.first("vector").alias("vector"))
               .mapInArrow(_placed(shared, False), f"cell int, h1 long, h2 long, vector {kind}"))
    queries = materialize(queries, "queries")
    first = materialize(_visited(placed, sizes, queries.withColumn("bound", F.lit(float("inf"))), shared, k + 1, plan), "own_cell")
    # a query has an answer from each slab of its own cell: the least of their k-th distances holds
    bound = first.groupBy("h1", "h2").agg(F.min("worst").alias("worst"))
    # a query whose own cell is empty has no answer yet
    visits = (queries.join(bound, ["h1", "h2"], "left").withColumn("worst", F.coalesce("worst", F.lit(float("inf"))))
              .select("cell", "h1", "h2", "vector", "worst")
              .mapInArrow(_reaching(shared, boxes), f"cell int, h1 long, h2 long, vector {kind}, bound double"))
    visits = materialize(visits, "visits")
    second = _visited(placed, sizes, visits, shared, k + 1, plan)
    order = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    found = (first.select("h1", "h2", "entries").unionByName(second.select("h1", "h2", "entries"))
             .repartition("h1", "h2").select("h1", "h2", F.inline("entries"))
             .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
             .groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("r", "score", "id", "same"))).alias("l")))
    # many queries may have one vector: the skewed side of this join is that of the queries, which AQE splits
    mine = F.filter("l", lambda x: ~(x["same"] & x["id"].eqNullSafe(F.col("query_id"))))
    return (wanted.join(found, ["h1", "h2"]).select("query_id", F.posexplode(F.slice(mine, 1, k)).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")))
