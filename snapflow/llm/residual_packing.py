"""Hierarchical residual packing of token pieces into sequences of a fixed capacity.

Each task packs its own items best-fit decreasing and closes the nearly full bins.  The underfull
bins are items of the next round: fewer tasks, each with the rest of several, pack them again, up
to one task.  A bin carries its members (at most ``capacity``, an item has a token or more), so no
round reads the documents again.  Every task gets at most about ``task_items`` items whatever the
input; the rounds end when one task has seen all rests or a round merged nothing.

Defined results
    null or empty text   one piece: the end-of-document id alone
    long text            cut into ``capacity``-token pieces, only the last may be shorter
    ties                 items of equal length are taken in the order of their hash
    repeated rows        each gets its own place
    null id              carried as null
    empty table          empty result
    extra columns        only id and text are read
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from snapflow.llm.common import DOC_ID, materialize, narrow, slices
from snapflow.llm.tokens import default_vocabulary, loaded

CAPACITY = 2048
END_ID = 0

_MEMBER = np.dtype([("doc_id", "<i8"), ("null_id", "u1"), ("piece", "<i4"), ("start", "<i8"),
                    ("length", "<i4"), ("crc", "<u4")])
_PIECES = "doc_id long, piece int, start long, length int, crc long"
_PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                           ("length", pa.int32()), ("crc", pa.int64())])
_BINS = "bin long, fill int, closed boolean, members binary"
_BIN_SCHEMA = pa.schema([("bin", pa.int64()), ("fill", pa.int32()), ("closed", pa.bool_()), ("members", pa.binary())])


def _cut(vocabulary, capacity: int):
    """Documents -> pieces: id, place, length and checksum; the ids themselves stay in the task."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        tokenizer = loaded(vocabulary.value)
        step = 4 * capacity
        for batch in slices(batches):
            ids = batch.column("doc_id")
            row, piece, length, crc = [], [], [], []
            for r, data in enumerate(tokenizer.encode_all(batch.column("text").cast(pa.binary()).to_pylist())):
                data += end
                for p, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    row.append(r)
                    piece.append(p)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            piece = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row, pa.int64())), pa.array(piece), pa.array(piece.astype(np.int64) * capacity),
                 pa.array(length, pa.int32()), pa.array(crc, pa.int64())], schema=_PIECE_SCHEMA)
        tokenizer.cache.forget()             # the process lives on for other tasks
    return run


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
                 id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, crc`` of every piece of every document."""
    with open(vocabulary or default_vocabulary(), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    d = narrow(docs, id_col, text_col).withColumn(DOC_ID, F.col(DOC_ID).cast("long"))
    return d.mapInArrow(_cut(shared, capacity), _PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item goes to the open bin with the least room that takes it.
    Rooms are whole numbers up to ``capacity``; one bit a room says whether a bin has it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    have = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = have >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                have ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= size
        if room:
            by_room[room].append(b)
            have |= 1 << room
    return bins


def _pack(round_no: int, capacity: int, full: int):
    """One round in one task: its items (pieces or underfull bins) -> bins."""
    def run(batches):
        fills, members = [], []
        for batch in batches:
            fills.append(batch.column("fill").to_numpy())
            members += batch.column("members").to_pylist()
        if not members:
            return
        fills = np.concatenate(fills)
        base = (round_no << 56) | (TaskContext.get().partitionId() << 32)
        bins = best_fit(fills, capacity)
        for at in range(0, len(bins), 4096):
            part = bins[at:at + 4096]
            fill = [int(fills[b].sum()) for b in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(base + at, base + at + len(part)), pa.int64()), pa.array(fill, pa.int32()),
                 pa.array([x >= full for x in fill]), pa.array([b"".join([members[i] for i in b]) for b in part], pa.binary())],
                schema=_BIN_SCHEMA)
    return run


def _as_items(batches):
    for b in batches:
        rec = np.zeros(b.num_rows, _MEMBER)
        rec["null_id"] = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        rec["doc_id"] = b.column("doc_id").fill_null(0).to_numpy()
        for name in ("piece", "start", "length", "crc"):
            rec[name] = b.column(name).to_numpy()
        data, w = rec.tobytes(), _MEMBER.itemsize
        yield pa.RecordBatch.from_arrays(
            [pa.array([data[i:i + w] for i in range(0, len(data), w)], pa.binary()), b.column("length")],
            names=["members", "fill"])


_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_PLACED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32())] + [
    (n, pa.int64()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")])


def _unpack(batches):
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            part = b.slice(at, 1024)
            bins, blobs = part.column("bin").to_numpy(), part.column("members").to_pylist()
            n = np.array([len(x) // _MEMBER.itemsize for x in blobs])
            rec = np.frombuffer(b"".join(blobs), _MEMBER)
            ends = np.cumsum(rec["length"].astype(np.int64))
            before = ends - rec["length"]
            heads = np.cumsum(n) - n
            offset = before - np.repeat(before[heads], n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rec["doc_id"].copy(), pa.int64(), mask=rec["null_id"].astype(bool)), pa.array(rec["piece"].copy()),
                 pa.array(rec["start"].copy()), pa.array(rec["length"].astype(np.int64)), pa.array(rec["crc"].astype(np.int64)),
                 pa.array(np.repeat(bins, n)), pa.array(offset)], schema=_PLACED_SCHEMA)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, task_items: int = 65_536, fan_in: int = 8,
                full_share: float = 0.99) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences as the rounds find."""
    kept = materialize(pieces, "token-pieces")
    n = kept.count()
    tasks = max(1, -(-n // task_items))
    spread = F.xxhash64("doc_id", "piece", "start", "length")
    items = kept.withColumn("__h", spread).repartition(tasks, "__h").sortWithinPartitions("__h").drop("__h")
    items = items.mapInArrow(_as_items, "members binary, fill int")
    closed, round_no, full = None, 1, int(full_share * capacity)
    while True:
        bins = materialize(items.mapInArrow(_pack(round_no, capacity, full), _BINS), f"packed-{round_no}")
        made = {bool(r[0]): r[1] for r in bins.groupBy("closed").count().collect()}
        rest, total = made.get(False, 0), sum(made.values())
        fewer = max(-(-tasks // fan_in), -(-rest // task_items), 1)
        last = tasks == 1 or not rest or (round_no > 1 and total == n)
        done = bins if last else bins.filter("closed")
        closed = done if closed is None else closed.unionByName(done)
        if last:
            return closed.select("bin", "members").mapInArrow(_unpack, _PLACED)
        n, tasks, round_no = rest, fewer, round_no + 1
        items = (bins.filter(~F.col("closed")).withColumn("__h", F.xxhash64("bin")).repartition(tasks, "__h")
                 .sortWithinPartitions("__h").select("members", "fill"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
                   id_col: str = DOC_ID, text_col: str = "text", **limits) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack_pieces(token_pieces(docs, capacity, vocabulary, id_col, text_col), capacity, **limits)
