"""Line dedup with two Bloom filters: keys of lines seen once, and keys seen twice.

1. Each task keeps the 64-bit hashes of its line keys that it saw once and those it saw twice, and
   sends both as sparse Bloom filter segments.  Segments merge by OR; a bit that two tasks set in
   the once-seen filter is set in the twice-seen one.  A key of two documents always ends there.
2. The twice-seen filter (size bounded by ``max_bits``) goes to the tasks.  Lines whose key it does
   not hold are unique and stay where they are; only the others, as 16-byte digests, are shuffled.
3. Counts of these suspects are exact: documents a key and the largest id are pre-aggregated before
   the shuffle, so a line of a third of all documents costs one row a task.

A filter that is too full sends more suspects; it never changes the result.

Defined results
    null or empty text      one empty line, never dropped (shorter than ``min_chars``)
    a key                   the line without ASCII white space at both ends, A-Z in lower case;
                            16-byte digests (XXH3-128) stand for keys
    a document              the rows of one id (those without id: one document); lines of the largest
                            id stay in all its rows, and each row is reported by itself
    null id                 never the largest: such rows lose every line that is dropped anywhere
    very long text          whole text in its own task
    empty table             empty result
    extra columns           pass through ``drop_repeated_lines`` untouched, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from snapflow.llm.common import DOC_ID, let, materialize, narrow, slices

_STRIP = b" \t\n\x0b\x0c\r"
_SEGMENT = 1 << 16               # bits of a segment; positions inside fit 16 bits
_PROBES = 3


def line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """Number and key of each line whose key has ``min_chars`` code points or more."""
    for i, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(_STRIP)
        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            yield i, key


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The probes of each hash, one row a probe (double hashing; ``bits`` is a power of two)."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(hashes + np.uint64(j) * step) & np.uint64(bits - 1) for j in range(_PROBES)])


def _segments(hashes: np.ndarray, bits: int) -> dict[int, bytes]:
    """Set bits of the filter of ``hashes``, by segment, as 16-bit places."""
    pos = np.unique(_positions(hashes, bits))
    seg, place = (pos >> np.uint64(16)).astype(np.int64), (pos & np.uint64(_SEGMENT - 1)).astype("<u2")
    heads = np.flatnonzero(np.diff(seg, prepend=-1))
    return {int(seg[a]): place[a:b].tobytes() for a, b in zip(heads, [*heads[1:], len(seg)])}


_FILTER = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def _local_filters(min_chars: int, bits: int, flush: int = 1_000_000):
    """Filters of a task's own documents; every ``flush`` hashes it sends what it has and starts
    anew (as if another task went on), so memory is bounded however large the partition is."""
    def rows(hashes: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(hashes), return_counts=True)
        once, twice = _segments(h, bits), _segments(h[n > 1], bits)
        keys = sorted(once)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), pa.array([once[k] for k in keys], pa.binary()),
             pa.array([twice.get(k, b"") for k in keys], pa.binary())], schema=_FILTER)

    def run(batches):
        held, n = [], 0
        for batch in slices(batches):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                h = {xxhash.xxh3_64_intdigest(k) for _, k in line_keys(text, min_chars)}
                if h:
                    held.append(np.fromiter(h, np.uint64, len(h)))
                    n += len(h)
            if n >= flush:
                yield rows(held)
                held, n = [], 0
        if n:
            yield rows(held)
    return run


_BITS = pa.schema([("segment", pa.int32()), ("bits", pa.binary())])


def _merge_segments(batches):
    """Rows sorted by segment -> the segment's twice-seen bits, one segment in memory at a time."""
    at, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()),
                                           pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())],
                                          schema=_BITS)

    for batch in batches:
        for seg, a, b in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice"))):
            if seg != at:
                if at is not None and twice.any():
                    yield done()
                at, once, twice = seg, np.zeros(_SEGMENT, bool), np.zeros(_SEGMENT, bool)
            a, b = np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2")
            twice[a[once[a]]] = True
            twice[b] = True
            once[a] = True
    if at is not None and twice.any():
        yield done()


def filter_bits(lines: int, max_bits: int) -> int:
    """Power of two: 16 bits a line, at least one segment, at most ``max_bits``."""
    return max(_SEGMENT, min(max_bits, 1 << max(0, 16 * lines - 1).bit_length()))


def twice_seen(d: DataFrame, min_chars: int, bits: int) -> bytes:
    """The twice-seen filter of all documents, ``bits`` / 8 bytes."""
    parts = d.select("text").mapInArrow(_local_filters(min_chars, bits), "segment int, once binary, twice binary")
    merged = (parts.repartition("segment").sortWithinPartitions("segment")
              .mapInArrow(_merge_segments, "segment int, bits binary"))
    out = bytearray(bits // 8)
    for seg, data in merged.toLocalIterator():
        out[seg * _SEGMENT // 8:(seg + 1) * _SEGMENT // 8] = data
    return bytes(out)


def _suspects(min_chars: int, bits: int, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("line", pa.int32()), ("key", pa.binary())])

    def run(batches):
        seen = np.frombuffer(shared.value, np.uint8)
        for batch in slices(batches):
            row, line, keys = [], [], []
            for r, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                for i, k in line_keys(text, min_chars):
                    row.append(r)
                    line.append(i)
                    keys.append(k)
            if not row:
                continue
            h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
            pos = _positions(h, bits)
            hit = np.flatnonzero(((seen[(pos >> np.uint64(3)).astype(np.int64)] >> (pos & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0))
            if not len(hit):
                continue
            row = np.array(row)[hit]
            digest = [xxhash.xxh3_128_digest(keys[i]) for i in hit]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("th").take(take),
                 pa.array(np.array(line, np.int32)[hit]), pa.array(digest, pa.binary())], schema=schema)
    return run


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, max_bits: int = 1 << 28,
                   id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """``doc_id, th, lines``: the numbers of the lines to drop, for documents that lose any.
    ``th`` is the text's XXH64; with the id it tells rows that share an id apart."""
    d = narrow(docs, id_col, text_col).select(F.col(DOC_ID).cast("long").alias(DOC_ID), "text", F.xxhash64("text").alias("th"))
    total = d.agg(F.sum(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0]
    bits = filter_bits(total or 0, max_bits)
    shared = d.sparkSession.sparkContext.broadcast(twice_seen(d, min_chars, bits))
    suspects = materialize(d.mapInArrow(_suspects(min_chars, bits, shared),
                                        "doc_id long, th long, line int, key binary"), "suspect-lines")
    held = materialize(suspects.select("key", "doc_id").distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
                       .filter(F.col("n") >= min_docs), "held-lines")
    # lines of a thousandth of all suspects or more: a thousand keys at most, sent to every task
    common = suspects.count() / 1000
    hot = F.broadcast(held.filter(F.col("n") >= common))
    met = (suspects.join(hot, "key").unionByName(
        suspects.join(hot.select("key"), "key", "left_anti").join(held.filter(F.col("n") < common), "key")))
    return (met.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "th").agg(F.collect_set("line").alias("lines")))


def _with_drops(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str) -> DataFrame:
    hit = drops.select(F.col("doc_id").alias("__drop_id"), F.col("th").alias("__drop_th"), F.col("lines").alias("__drop_lines"))
    text = F.coalesce(docs[text_col], F.lit(""))
    # the line numbers of a task's documents fit a hash table; a merge join would sort whole texts
    return docs.join(hit.hint("shuffle_hash"), docs[id_col].cast("long").eqNullSafe(F.col("__drop_id"))
                     & (F.xxhash64(text) == F.col("__drop_th")), "left").drop("__drop_id", "__drop_th")


def kept_text(text: Column, lines: Column) -> Column:
    """The text without the numbered lines; null ``lines``: the text as it is."""
    def rest(parts: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), lines)
        return F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")
    return F.when(lines.isNull(), text).otherwise(let(F.split(text, "\n"), rest))


def line_report(docs: DataFrame, id_col: str = DOC_ID, text_col: str = "text", **limits) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` of every row."""
    d = narrow(docs, id_col, text_col)
    j = _with_drops(d, repeated_lines(d, **limits), DOC_ID, "text")
    return j.select(DOC_ID, (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
                    F.coalesce(F.size("__drop_lines"), F.lit(0)).cast("long").alias("n_dropped"),
                    kept_text(F.col("text"), F.col("__drop_lines")).alias("kept_text"))


def drop_repeated_lines(docs: DataFrame, id_col: str = DOC_ID, text_col: str = "text", **limits) -> DataFrame:
    """The documents with their repeated lines removed; other columns as they came, null texts stay null."""
    j = _with_drops(docs, repeated_lines(docs, id_col=id_col, text_col=text_col, **limits), id_col, text_col)
    text = kept_text(docs[text_col], F.col("__drop_lines"))
    return j.select(*[(text if c == text_col else docs[c]).alias(c) for c in docs.columns])
