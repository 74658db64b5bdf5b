"""Packed token-id matrices: best-fit decreasing with a segment tree over the bins' rooms.

Each task tokenizes its documents and packs them window by window (``window_tokens`` ids in memory).
Nearly full bins leave as matrix rows; the others, up to half a window of ids, emptiest first, are
opened again and packed with the next window.  So a task never holds more than a window and one
document, and each pass is paid for by half a window of new ids.  Nothing is shuffled.

A row is a sequence of exactly ``capacity`` ids (padded), with the cumulative segment lengths that
variable-length attention takes and the places where position ids start again at 0.

Defined results
    null or empty text   a segment of the end-of-document id alone
    overlong document    cut into ``capacity``-token pieces; pieces in order give its ids back
    ties                 equal lengths in input order
    repeated rows        each packed
    null id              carried as null in ``doc_ids``
    empty table          empty result
    extra columns        only id and text are read
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from snapflow.llm.common import DOC_ID, narrow, slices
from snapflow.llm.tokens import default_vocabulary, loaded

CAPACITY = 2048
END_ID = 0
PAD_ID = 0

_ROWS = ("sequence_id long, n_tokens int, n_segments int, doc_ids array<long>, pieces array<int>, "
         "cu_seqlens array<int>, position_resets array<int>, ids_crc32 long, input_ids binary")
_SCHEMA = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()),
                     ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())),
                     ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
                     ("ids_crc32", pa.int64()), ("input_ids", pa.binary())])


class RoomTree:
    """Segment tree over rooms 0..capacity: how many open bins have each; finds the least room
    that is at least a size in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, size: int) -> int | None:
        count, i = self.count, size + self.leaves
        while not count[i]:
            while i & 1:                 # a right child: everything right of it is above its parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers."""
    tree, at_room, bins = RoomTree(capacity), {}, []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.least(lengths[i])
        if room is None:
            room, b = capacity, len(bins)
            bins.append([])
        else:
            b = at_room[room].pop()
            tree.add(room, -1)
        bins[b].append(i)
        room -= lengths[i]
        if room:
            tree.add(room, 1)
            at_room.setdefault(room, []).append(b)
    return bins


def _rows(vocabulary, capacity: int, window_tokens: int, full: int, width: str):
    end, size = np.array([END_ID], "<u4").tobytes(), np.dtype(width).itemsize

    def run(batches):
        tokenizer, step = loaded(vocabulary.value), 4 * capacity
        number = TaskContext.get().partitionId() << 32
        held, tokens = [], 0               # (doc_id, piece, ids)

        def emit(last: bool):
            nonlocal held, tokens, number
            bins = best_fit_decreasing([len(x[2]) // 4 for x in held], capacity)
            bins = sorted((sum(len(held[i][2]) for i in b) // 4, k, b) for k, b in enumerate(bins))
            rows, rest, left = [], [], 0
            for n, _, b in bins:
                parts = [held[i] for i in b]
                # opened again: the emptiest bins, up to half a window, so that every pass makes room
                if n < full and not last and left + n <= window_tokens // 2:
                    rest += parts
                    left += n
                    continue
                ends = np.cumsum([len(x[2]) // 4 for x in parts]).tolist()
                ids = np.frombuffer(b"".join([x[2] for x in parts]), "<u4").astype(width)
                data = ids.tobytes() + np.full(capacity - n, PAD_ID, width).tobytes()
                rows.append((number, n, len(parts), [x[0] for x in parts], [x[1] for x in parts], [0, *ends],
                             [0, *ends[:-1]], zlib.crc32(ids.astype("<u4")), data))
                number += 1
            held, tokens = rest, sum(len(x[2]) for x in rest) // 4
            for i in range(0, len(rows), 512):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 512]), _SCHEMA)], schema=_SCHEMA)

        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lo in range(0, len(texts), 256):
                for doc, data in zip(ids[lo:lo + 256], tokenizer.encode_all(texts[lo:lo + 256])):
                    data += end
                    held += [(doc, p, data[at:at + step]) for p, at in enumerate(range(0, len(data), step))]
                    tokens += len(data) // 4
                    if tokens >= window_tokens:
                        yield from emit(False)
        tokenizer.cache.forget()             # the process lives on for other tasks
        if held:
            yield from emit(True)
    return run


def packed_matrix(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
                  window_tokens: int = 4_000_000, full_share: float = 0.99, width: str = "<u2",
                  id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """One row a sequence.  ``input_ids``: ``capacity`` little-endian ids of type ``width`` (16 bits
    hold the vocabulary); ``ids_crc32``: of the ids without padding as 32-bit numbers."""
    with open(vocabulary or default_vocabulary(), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    d = narrow(docs, id_col, text_col).withColumn(DOC_ID, F.col(DOC_ID).cast("long"))
    return d.mapInArrow(_rows(shared, capacity, window_tokens, int(full_share * capacity), width), _ROWS)
