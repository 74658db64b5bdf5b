"""SimHash near-duplicates by covering codes.

Fingerprints that differ in at most ``distance`` bits are linked; documents take the smallest id
they reach over links.

The 64 bits are cut into blocks whose tolerances ``t`` satisfy sum(t + 1) > distance, so two linked
fingerprints differ in at most ``t`` bits of some block.  Each block has a covering code: its code
words are the anchors, and every value lies within the covering radius of one of them.  A
fingerprint is at home at its nearest anchor of a block and is replicated to every anchor within
radius plus tolerance; there it meets each linked fingerprint that is at home.  Codes are products
of the perfect Golay code of 23 bits (radius 3), the perfect Hamming code of 15 (radius 1) and plain
bits (radius 0), and radius plus tolerance is counted part by part, which leaves out anchors that no
linked pair shares.

Copies collapse to one fingerprint first.  A crowded anchor is cut into tiles of ``tile`` home times
``tile`` replicated fingerprints; every tile is compared, none is cut short.  A tile sends a spanning
star of each cluster it finds, never all pairs.

Defined results
    null or empty text, no word    fingerprint zero, linked like any other
    very long text                 whole text in its own task
    ties, repeated rows            equal fingerprints are one node
    null id                        does not count as smallest; a group of null ids only has null
    empty table                    empty result
    extra columns                  only id and text are read
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from snapflow.llm.common import DOC_ID, materialize, release, narrow, slices

WORDS = 4
DISTANCE = 4
SEED = 42


# ---- fingerprints ---------------------------------------------------------------------------

def simhash(text: bytes, words: int = WORDS) -> int:
    """Majority bits over the XXH64 of all word shingles."""
    found = text.lower().split()
    if not found:
        return 0
    line, n = b" ".join(found), len(found)
    if n <= words:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        part = h[i:i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def run(batches):
        for b in slices(batches):
            fp = np.array([simhash(t, words) for t in b.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64)), b.column("digest")],
                                             names=["doc_id", "fp", "digest"])
    return run


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """``doc_id, fp, digest``: the 64 bits as a signed long, and the text's digest."""
    d = narrow(docs, id_col, text_col).select(F.col(DOC_ID).cast("long").alias(DOC_ID), "text", text_digest(F.col("text")).alias("digest"))
    return d.mapInArrow(_fingerprints(words), "doc_id long, fp long, digest binary")


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


# ---- covering codes -------------------------------------------------------------------------

class Part:
    """A perfect code (or plain bits) on ``bits`` bits, given by its syndrome.

    ``flips[s][e]``: the error patterns of syndrome ``s`` whose weight is radius + e; a value xor
    such a pattern is a code word that far away."""

    def __init__(self, bits: int, radius: int, columns: list[int] | None, reach: int):
        self.bits, self.radius = bits, radius
        checks = max(columns).bit_length() if columns else 0
        self.columns = columns
        self.flips: list[list[list[int]]] = [[[] for _ in range(reach + 1)] for _ in range(1 << checks)]
        for weight in range(radius + reach + 1):
            for places in combinations(range(bits), weight):
                syndrome = 0
                for p in places:
                    syndrome ^= columns[p] if columns else 0
                self.flips[syndrome][max(0, weight - radius)].append(sum(1 << p for p in places))

    def syndromes(self, values: np.ndarray) -> np.ndarray:
        s = np.zeros(len(values), np.int64)
        for p, column in enumerate(self.columns or ()):
            s ^= np.where((values >> np.uint64(p)) & np.uint64(1), column, 0)
        return s


def _golay_columns() -> list[int]:
    """Remainders of x^p by the generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1."""
    out, r = [], 1
    for _ in range(23):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= 0b101011100011
    return out


def _part(kind: tuple, reach: int) -> Part:
    name, bits = kind
    if name == "golay":
        return Part(23, 3, _golay_columns(), reach)
    if name == "hamming":
        return Part(15, 1, list(range(1, 16)), reach)
    return Part(bits, 0, None, reach)


#: Blocks of (parts, tolerance).  The wide layout has more anchors and more replicas.
LAYOUTS = {
    "small": [([("golay", 23), ("plain", 2)], 1), ([("golay", 23), ("plain", 2)], 1), ([("plain", 14)], 0)],
    "wide": [([("golay", 23), ("plain", 13)], 2), ([("plain", 28)], 1)],
}
#: Distinct fingerprints from which the wide layout costs less; both find the same links.
WIDE_FROM = 50_000_000


class Block:
    """A slice of the fingerprint with its code: home anchor and replicas of many values at once."""

    def __init__(self, shift: int, parts: list[tuple], tolerance: int):
        self.tolerance, self.parts, at = tolerance, [], shift
        for kind in parts:
            part = _part(kind, tolerance)
            self.parts.append((at, part))
            at += part.bits
        self.end = at

    @lru_cache(maxsize=None)
    def _patterns(self, syndromes: tuple[int, ...]) -> np.ndarray:
        """Error patterns of the block with at most ``tolerance`` beyond the radii, home first."""
        found = []
        for extra in product(range(self.tolerance + 1), repeat=len(self.parts)):
            if sum(extra) <= self.tolerance:
                choices = [[f << at for f in part.flips[s][e]] for (at, part), s, e in zip(self.parts, syndromes, extra)]
                found += [sum(c) for c in product(*choices)]
        return np.array(found, np.uint64)

    def anchors(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, at home) of every fingerprint and each anchor within reach."""
        mask = np.uint64(sum(((1 << part.bits) - 1) << at for at, part in self.parts))
        keys = [part.syndromes(fps >> np.uint64(at)) for at, part in self.parts]
        combined = np.zeros(len(fps), np.int64)
        for (_, part), k in zip(self.parts, keys):
            combined = combined * len(part.flips) + k
        rows, anchors, home = [], [], []
        order = np.argsort(combined, kind="stable")
        heads = np.flatnonzero(np.diff(combined[order], prepend=-1))
        for a, b in zip(heads, [*heads[1:], len(order)]):
            r = order[a:b]
            flips = self._patterns(tuple(int(k[r[0]]) for k in keys))
            rows.append(np.repeat(r, len(flips)))
            anchors.append((((fps[r] & mask)[:, None]) ^ flips[None, :]).ravel())
            home.append(np.tile(np.arange(len(flips)) == 0, len(r)))
        return np.concatenate(rows), np.concatenate(anchors), np.concatenate(home)


@lru_cache(maxsize=None)
def blocks_of(layout: str) -> list[Block]:
    out, shift = [], 0
    for parts, tolerance in LAYOUTS[layout]:
        out.append(Block(shift, parts, tolerance))
        shift = out[-1].end
    return out


def check_layout(layout: str, distance: int) -> None:
    blocks = blocks_of(layout)
    if blocks[-1].end != 64 or sum(b.tolerance + 1 for b in blocks) <= distance:
        raise ValueError(f"layout {layout} does not guarantee distance {distance}")


# ---- links ----------------------------------------------------------------------------------

def _replicas(layout: str):
    names = ["block", "anchor", "home", "fp"]

    def run(batches):
        for batch in batches:
            whole = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(whole), 8192):
                fps = whole[at:at + 8192]
                for k, block in enumerate(blocks_of(layout)):
                    r, a, h = block.anchors(fps)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(r), k, np.int32)), pa.array(a.view(np.int64)), pa.array(h),
                         pa.array(fps[r].view(np.int64))], names=names)
    return run


def _stars(fps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning stars (smallest, member) of the linked clusters among distinct fingerprints."""
    n = len(fps)
    if n < 2:
        return []
    if n <= 512:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
        if int(near.sum()) == n:
            return []
    out, left = [], fps
    while len(left) > 1:
        front, left, members = left[:1], left[1:], [left[:1]]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for f in front:
                hit |= np.bitwise_count(left ^ f) <= distance
            front, left = left[hit], left[~hit]
            members.append(front)
        m = np.concatenate(members)
        if len(m) > 1:
            out.append((np.full(len(m) - 1, m.min()), m[m != m.min()]))
    return out


def _compare(distance: int):
    """Rows sorted by tile -> link stars.  One tile is in memory at a time."""
    keys = ("block", "anchor", "i", "j")

    def links(fps):
        return _stars(np.unique(fps), distance)

    def run(batches):
        held, held_key = [], None
        for b in batches:
            cols = [b.column(k).to_numpy() for k in keys]
            fps = b.column("fp").to_numpy().view(np.uint64)
            if not len(fps):
                continue
            change = np.zeros(len(fps), bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            heads = [0, *np.flatnonzero(change).tolist(), len(fps)]
            found = []
            for a, z in zip(heads, heads[1:]):
                key = tuple(int(c[a]) for c in cols)
                if key != held_key:
                    if held:
                        found += links(np.concatenate(held))
                    held, held_key = [], key
                held.append(fps[a:z])
            if found:
                yield _edges(found)
        if held:
            found = links(np.concatenate(held))
            if found:
                yield _edges(found)
    return run


def _edges(found) -> pa.RecordBatch:
    u, v = np.concatenate([x[1] for x in found]), np.concatenate([x[0] for x in found])
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])


def linked(nodes: DataFrame, distance: int = DISTANCE, layout: str | None = None, tile: int = 4096) -> DataFrame:
    """``u, v``: links that span every cluster of the distinct fingerprints ``nodes.fp``."""
    layout = layout or ("wide" if nodes.count() >= WIDE_FROM else "small")
    check_layout(layout, distance)
    rows = nodes.select("fp").mapInArrow(_replicas(layout), "block int, anchor long, home boolean, fp long")
    crowded = (rows.groupBy("block", "anchor").agg(F.count("*").alias("n"), F.count_if("home").alias("h"))
               .filter(F.col("n") > tile)
               .select("block", "anchor", F.ceil(F.col("h") / tile).cast("int").alias("rows"),
                       F.ceil(F.col("n") / tile).cast("int").alias("cols")))
    place = F.xxhash64("fp", F.lit(1))
    rows = rows.join(crowded, ["block", "anchor"], "left").select(
        "block", "anchor", "home", "fp", F.greatest(F.coalesce("rows", F.lit(1)), F.lit(1)).alias("rows"),
        F.coalesce("cols", F.lit(1)).alias("cols"))
    # a replica goes to one column of tiles, a home fingerprint also to one row of them
    as_replica = rows.select("block", "anchor", "fp", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"),
                             F.pmod(place, F.col("cols")).cast("int").alias("j"))
    as_home = (rows.filter(F.col("home") & (F.col("cols") > 1))
               .select("block", "anchor", "fp", F.pmod(place, F.col("rows")).cast("int").alias("i"),
                       F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j")))
    tiles = as_replica.unionByName(as_home)
    by = ["block", "anchor", "i", "j"]
    return tiles.repartition(*by).sortWithinPartitions(*by).mapInArrow(_compare(distance), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v``: every linked node and the smallest node of its component.

    Alternating large-star and small-star steps: each node's larger (smaller) neighbours are tied
    to its smallest one.  Minima are pre-aggregated before the shuffle; rounds grow with the
    logarithm of the longest chain; each round is a shared table, kept until the next one is written.
    """
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    n, old = e.count(), None
    while n:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        if old is not None:
            release(old)
        old, e, before = e, materialize(small, "links"), n
        n = e.count()
        # both are sets: equally many rows and none of the new ones unknown before
        if n == before and not e.join(old, ["u", "v"], "left_anti").limit(1).count():
            release(old)
            break
    return e


def grouped(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, layout: str | None = None,
            id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """``doc_id, fp, digest, root, component_id`` of every row.  ``root``, the smallest fingerprint of
    the group, names each group, also those of null ids only; a text has one root."""
    fp = materialize(fingerprints(docs, words, id_col, text_col), "simhash")
    nodes = fp.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(linked(nodes, distance, layout))
    labelled = nodes.join(roots, nodes["fp"] == roots["u"], "left").select("fp", "first", F.coalesce("v", "fp").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    of = labelled.join(smallest, "root").select("fp", "root", "component_id")
    return fp.join(of, "fp").select(DOC_ID, "fp", "digest", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, layout: str | None = None,
                    id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    return grouped(docs, words, distance, layout, id_col, text_col).select(
        DOC_ID, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
