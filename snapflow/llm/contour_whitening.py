"""Whitening of embeddings by FEAST contour integration.

Spark gathers the moments of the whole table: exact sums, then the covariance of the vectors centred
at the nearest whole mean, as whole numbers, so that no order of adding changes a digit.  Inertia
counts of the shifted covariance (signs of its symmetric pivots) cut the spectrum, from the top, into
intervals of a few eigenvalues.  Spark tasks then work on one interval each: Gauss-Legendre
quadrature of complex shifted solves along a circle around it projects a random block onto the
interval's eigenspace, Rayleigh-Ritz takes the eigenvectors from the block, and rounds repeat until
their residuals vanish.  The driver compares the number found in every interval with its inertia
count: a missed or doubled eigenvalue is an error.  What passes through the driver is d x d numbers.

Defined results
    unusable row         null vector, null, non-finite or huge (2^40 and more) entry, no entry, or a
                         length other than the most frequent one (ties: the greatest): dropped
    null or repeated id  each row is whitened
    equal vectors        equal rows, each counted
    no spread            components whose eigenvalue is below 1e-12 of the trace have no unit scale and
                         are left out; a table of one distinct vector has none: empty result
    equal eigenvalues    any orthonormal basis of their space
    empty table          empty result
    extra columns        only id and vector are read
"""

from __future__ import annotations

from dataclasses import dataclass
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapflow.llm.common import materialize
from snapflow.llm.vectors import blocks, usable

SCALE, SHIFT = 64, 1_000_000          # fixed values: x = floor(64 * c) + 1000000
LIMIT = float(2 ** 40)
COMPONENTS = 32
NO_SPREAD = 1e-12                     # least eigenvalue, as a share of the trace
NODES = 12                            # of the half circle
MOST = 8                              # eigenvalues of an interval, unless they cannot be told apart
_EXACT = 2.0 ** 53


# ---- moments --------------------------------------------------------------------------------

def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``x`` of each entry, as exact doubles."""
    return np.floor(SCALE * vectors) + SHIFT


def _sums(batches):
    total, n = None, 0
    for _, v in blocks(batches):
        s = whole_numbers(v).astype(np.int64).sum(axis=0)
        total, n = (s if total is None else total + s), n + len(v)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total) + 1), pa.int32()), pa.array([n, *total.tolist()], pa.int64())],
                                         names=["i", "v"])


def _decimals(values: list[int]) -> pa.Array:
    from decimal import Decimal
    return pa.array([Decimal(x) for x in values], pa.decimal128(38, 0))


def _products(centre: np.ndarray):
    """Sums of products of the centred whole numbers, upper triangle, one row an entry.  A block has
    so few rows that its sums stay below 2^53, where doubles hold every whole number."""
    def run(batches):
        d = len(centre)
        upper = np.triu_indices(d)
        total, pending, room = [0] * len(upper[0]), np.zeros(len(upper[0])), _EXACT
        for _, v in blocks(batches):
            x = whole_numbers(v) - centre
            peak = float(np.abs(x).max()) if x.size else 0.0
            step = int(max(1, min(len(x), _EXACT // max(1.0, peak * peak))))
            for at in range(0, len(x), step):
                part = x[at:at + step]
                bound = peak * peak * len(part)
                if bound > room:
                    total, pending, room = [a + int(b) for a, b in zip(total, pending)], np.zeros(len(pending)), _EXACT
                pending += (part.T @ part)[upper]
                room -= bound
        total = [a + int(b) for a, b in zip(total, pending)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), _decimals(total)], names=["i", "v"])
    return run


def _gathered(parts: DataFrame) -> list[int]:
    """Sums by entry over all tasks: as many numbers as an entry number can have, whatever the rows."""
    return [int(r["v"]) for r in parts.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()]


@dataclass
class Moments:
    n: int
    sums: list[int]                    # S, exact
    covariance: np.ndarray             # every entry the nearest double


def moments(rows: DataFrame) -> Moments | None:
    first = _gathered(rows.mapInArrow(_sums, "i int, v long").select("i", F.col("v").cast("decimal(38,0)").alias("v")))
    if not first:
        return None
    n, sums = first[0], first[1:]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    d = len(sums)
    products = _gathered(rows.mapInArrow(_products(np.array(centre, np.float64)), "i int, v decimal(38,0)"))
    covariance = np.empty((d, d))
    for p, i, j in zip(products, *np.triu_indices(d)):
        covariance[i, j] = covariance[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
    return Moments(n, sums, covariance)


# ---- inertia --------------------------------------------------------------------------------

def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``a`` above ``shift``: positive pivots of the symmetric factorisation of
    ``a - shift`` with complete pivoting (a pivot of two rows has one of each sign)."""
    m = a - shift * np.eye(len(a))
    positive, growth = 0, (1 + 17 ** 0.5) / 8
    tiny = np.finfo(float).eps * max(1e-300, np.abs(m).max())
    while len(m):
        diagonal = np.abs(np.diag(m))
        k = int(diagonal.argmax())
        off = np.abs(np.tril(m, -1))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[k] >= growth * off[i, j]:
            if diagonal[k] <= tiny:
                break
            positive += m[k, k] > 0
            rest = np.delete(np.arange(len(m)), k)
            c = m[rest, k]
            m = m[np.ix_(rest, rest)] - np.outer(c, c) / m[k, k]
        else:
            positive += 1
            rest = np.delete(np.arange(len(m)), [i, j])
            c = m[np.ix_(rest, [i, j])]
            m = m[np.ix_(rest, rest)] - c @ np.linalg.solve(m[np.ix_([i, j], [i, j])], c.T)
    return int(positive)


@dataclass
class Interval:
    low: float
    high: float
    count: int                         # by inertia


def intervals(a: np.ndarray, components: int, most: int = MOST) -> list[Interval]:
    """Intervals, from the top, that hold the ``components`` greatest eigenvalues of spread.

    Cuts are halved until an interval holds at most ``most`` or is too narrow to cut."""
    trace = float(np.trace(a))
    if not trace > 0:
        return []
    floor, top = NO_SPREAD * trace, float(np.abs(a).sum(axis=1).max()) * (1 + 1e-12)
    wanted = min(components, count_above(a, floor))
    stack, found, have = [Interval(floor, top, count_above(a, floor))], [], 0
    while stack and have < wanted:
        x = stack.pop()
        if x.count <= most or x.high - x.low <= 1e-10 * top:
            if x.count:
                found.append(x)
                have += x.count
            continue
        mid = (x.low + x.high) / 2
        above = count_above(a, mid) - have
        stack += [Interval(x.low, mid, x.count - above), Interval(mid, x.high, above)]
    return found


# ---- contour integration --------------------------------------------------------------------

def contour_pairs(a: np.ndarray, low: float, high: float, count: int, nodes: int = NODES,
                  rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors) of ``a`` in the interval from ``low`` to ``high``."""
    d, centre, radius = len(a), (low + high) / 2, (high - low) / 2
    scale = float(np.abs(a).sum(axis=1).max())
    angles, weights = np.polynomial.legendre.leggauss(nodes)
    angles = np.pi / 2 * (1 + angles)                             # the upper half circle
    points = centre + radius * np.exp(1j * angles)
    block = np.random.default_rng(7).standard_normal((d, min(d, count + max(4, count // 2))))
    eye = np.eye(d)
    inverses = [np.linalg.inv(z * eye - a) for z in points] if d <= 256 else None
    last = np.inf
    for _ in range(rounds):
        q = np.zeros_like(block)
        for k, (z, angle, weight) in enumerate(zip(points, angles, weights)):
            solved = inverses[k] @ block if inverses else np.linalg.solve(z * eye - a, block.astype(complex))
            q += weight / 2 * radius * (np.exp(1j * angle) * solved).real
        base, _ = np.linalg.qr(q)
        base, _ = np.linalg.qr(base)
        values, ritz = np.linalg.eigh(base.T @ a @ base)          # Rayleigh-Ritz, as wide as the block
        block = base @ ritz
        residual = np.linalg.norm(a @ block - block * values, axis=0)
        inside = (values > low) & (values <= high)
        if inside.sum() == count:
            worst = residual[inside].max(initial=0.0)
            if worst <= 4e-16 * scale * d ** 0.5 or (worst <= 1e-13 * scale and worst >= last / 2):
                order = np.argsort(-values[inside])
                return values[inside][order], block[:, inside][:, order]
            last = min(last, worst)
    raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues between {low} and {high} after {rounds} rounds")


def components_of(spark, a: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns): one Spark task an interval."""
    parts = intervals(a, components)
    if not parts:
        return np.zeros(0), np.zeros((len(a), 0))
    shared = spark.sparkContext.broadcast(a)                      # d x d, whatever the rows

    def solve(batches):
        for batch in batches:
            for r in batch.to_pylist():
                values, vectors = contour_pairs(shared.value, r["low"], r["high"], r["count"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["i"]] * len(values), pa.int32()), pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))],
                    names=["i", "value", "vector"])

    jobs = spark.createDataFrame([(i, x.low, x.high, x.count) for i, x in enumerate(parts)], "i int, low double, high double, count int")
    found = jobs.repartition(len(parts), "i").mapInArrow(solve, "i int, value double, vector array<double>").collect()
    held = [sum(r["i"] == i for r in found) for i in range(len(parts))]
    if held != [x.count for x in parts]:
        raise ArithmeticError(f"contours found {held} eigenvalues, inertia counts {[x.count for x in parts]}")
    found.sort(key=lambda r: -r["value"])
    values = np.array([r["value"] for r in found[:components]])
    vectors = np.array([r["vector"] for r in found[:components]]).T
    return values, vectors


# ---- whitening ------------------------------------------------------------------------------

@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray                 # eigenvalues, falling
    vectors: np.ndarray                # unit eigenvectors, as columns
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values

    def to_json(self) -> str:
        return json.dumps({"n": self.n, "sums": self.sums, "trace": self.trace, "values": self.values.tolist(),
                           "vectors": self.vectors.tolist()})

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact while below 2^63."""
        return self.n * x.astype(np.int64) - np.array(self.sums, np.int64)

    def whiten(self, deviation: np.ndarray) -> np.ndarray:
        return (deviation / self.n) @ (self.vectors / np.sqrt(self.values))


def fit(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """The whitening of all usable rows; ``None`` for a table without one."""
    m = moments(usable(table, id_col, vector_col, LIMIT))
    if m is None:
        return None
    values, vectors = components_of(table.sparkSession, m.covariance, components)
    return Whitening(m.n, m.sums, values, vectors, float(np.trace(m.covariance)))


def whitened(table: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, deviation, whitened``: one row a usable vector, its whitened components as an array.
    ``deviation``: squared distance from the mean times n squared, exact."""
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        w = shared.value
        for ids, v in blocks(batches):
            apart = w.deviations(whole_numbers(v))
            rough = (apart.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)
            if rough < 2.0 ** 62:
                squares = pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                squares = _decimals([sum(x * x for x in row) for row in apart.tolist()])
            z = w.whiten(apart)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([ids, squares, lists], names=["vec_id", "deviation", "whitened"])

    return usable(table, id_col, vector_col, LIMIT).mapInArrow(run, schema)


def identity_error(rows: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the covariance of ``rows.whitened`` minus the identity, measured."""
    def run(batches):
        upper = np.triu_indices(components)
        total, n = np.zeros(components + len(upper[0])), 0
        for batch in batches:
            z = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, components)
            total += np.concatenate([z.sum(axis=0), (z.T @ z)[upper]])
            n += len(z)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total) + 1, dtype=np.int32)), pa.array([float(n), *total])], names=["i", "v"])

    if not components:
        return None
    sums = rows.select("whitened").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    n, total = sums[0]["v"], np.array([r["v"] for r in sums[1:]])
    mean, second = total[:components] / n, np.zeros((components, components))
    second[np.triu_indices(components)] = total[components:] / n
    covariance = second - np.triu(np.outer(mean, mean))
    return float(np.abs(covariance - np.eye(components)).max())


def whitening_report(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a usable vector and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error, deviation_exact``.  ``deviation`` is NULL beyond the range of a long (some ten
    million rows of unit vectors); ``deviation_exact`` holds it in any case."""
    model = fit(table, components, id_col, vector_col)
    rows = whitened(table, model, id_col, vector_col)
    k = len(model.values) if model else 0
    if k:
        rows = materialize(rows, "whitened")
    error = identity_error(rows, k)
    share = F.array(*[F.lit(float(x)) for x in model.explained]) if k else F.array().cast("array<double>")
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
                    F.col("deviation").try_cast("long").alias("deviation"), F.col("value").alias("whitened"),
                    F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
                    F.col("deviation").alias("deviation_exact")))
