"""Cross-tokenizer alignment with inverted pair bitmaps.

A byte-level vocabulary (A) and a SentencePiece vocabulary (B) cut the same bytes into tokens.  Offsets
where tokens of both end cut a text into groups; the two tokens that end there are a link.  For every
pair of linked ids an inverted list tells which documents link it, as a bitmap over the 65,536 documents
of a container, compressed as a sorted list of 16-bit numbers while it is sparse.  How often a document
links a pair, less one, stands in multiplicity planes: plane p holds the documents whose number has bit
p.  So counts come from popcounts alone: documents from the bitmap, links from bitmap and planes,
summed over the containers.  The counted pairs then go back along the same postings: each list, joined
with its pair's score, gives every document on it its share of ``count_sum`` and ``n_best``.

A task encodes its texts chunk by chunk (a blank between two other characters is a token start in both
vocabularies, so a chunk's groups do not depend on its neighbours) with a bounded cache of chunks; a
vocabulary without that property gets whole texts as chunks.  Lists are built in bounded containers
and written once; only lists and counts are shuffled, no tokens.

Defined results
    null or empty text    no tokens: zeros, ``groups_sha256`` ''
    joined bytes differ   (a text with U+2581, which B reads as a blank, or with broken UTF-8): the same
    special tokens        their strings in a text are plain text
    ties                  every pair with the highest count of its B id is best
    null or repeated ids  each row is a document of its own
    empty table           empty result
    extra columns         only id and text are read
"""

from __future__ import annotations

from hashlib import sha256
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapflow.llm.common import DOC_ID, materialize, slices
from snapflow.llm.tokens import _byte_letters

BLANK = "▁"
CONTAINER = 1 << 16                # documents of a container
POSTINGS = 4_000_000               # (pair, document) entries after which a container closes early
_CACHE_LIMIT = 300_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ADJACENT = re.compile(r"\s\s")


# ---- encoding -------------------------------------------------------------------------------

class Aligner:
    """Both tokenizers of one task process, with a bounded cache of chunks."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        value = {c: i for i, c in enumerate(_byte_letters())}
        self.a_bytes = {i: bytes(value[c] for c in t) if all(c in value for c in t) else t.encode()
                        for t, i in self.a.get_vocab().items()}
        n = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        if max(self.a_bytes, default=0) >= 1 << 17 or n > 1 << 15:
            raise ValueError("ids do not fit a pair's 32 bits")
        spec = json.loads(byte_level)
        split = spec.get("pre_tokenizer") or {}
        self.by_chunk = (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                         and not any(BLANK in p.lstrip(BLANK) for i, p in enumerate(names) if not self.b.is_byte(i)))
        self.cache: dict[str, tuple[bytes, bytes, int]] = {}
        most = max(self.a_bytes, default=-1) + 1
        self.a_length = np.array([len(self.a_bytes.get(i, b"")) for i in range(most)])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        self.b_code = 2 * most
        self.names = [f"{i}{mark}".encode() for i in range(most) for mark in ",|"] + [f"{i}{mark}".encode() for i in range(n) for mark in ",;"]
        self.name_length = np.array([len(x) for x in self.names])

    def chunks(self, text: str) -> list[str]:
        """Chunks of a blank and the text, each without the blank before it."""
        if not self.by_chunk:
            return [text]
        if text[-1] != " " and not text[0].isspace() and not _ADJACENT.search(text):
            return text.split(" ")
        found = _CUT.split(" " + text)
        found[0] = found[0][1:]
        return found

    def learn(self, chunks: list[str]) -> None:
        """Cache entries of chunks; many are encoded as one text, whose cuts are then checked."""
        odd = chunks
        if self.by_chunk:
            odd = [c for c in chunks if not c or c[0].isspace() or c[-1].isspace()]
            plain = list(set(chunks).difference(odd))
            for at in range(0, len(plain), 5000):
                if not self._learn_joined(plain[at:at + 5000]):
                    odd += plain[at:at + 5000]
        for at in range(0, len(odd), 5000):
            part = odd[at:at + 5000]
            encoded = self.a.encode_batch_fast([" " + c for c in part], add_special_tokens=False)
            for chunk, a, b in zip(part, encoded, self.b.encode(part, num_threads=1)):
                self.cache[chunk] = self.aligned(chunk, a.ids, b)

    def _learn_joined(self, chunks: list[str]) -> bool:
        text = " ".join(chunks)
        whole = (" " + text).encode()
        a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text), np.int64)
        if any(b"".join(map(d.__getitem__, x.tolist())) != whole for d, x in ((self.a_bytes, a), (self.b_bytes, b))):
            return False
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        common = end_a[np.isin(end_a, end_b, assume_unique=True)]
        stops = np.cumsum([len(c.encode()) + 1 for c in chunks])
        last = np.searchsorted(common, stops)
        if not np.array_equal(common[last], stops):
            return False
        at_a, at_b = np.searchsorted(end_a, common), np.searchsorted(end_b, common)
        links = (a[at_a] << 15 | b[at_b]).astype("<u4").tobytes()
        # tokens of both in the order of the groups' text, each with the mark that follows it
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        code = np.concatenate([2 * a + (common[group_a] == end_a), self.b_code + 2 * b + (common[group_b] == end_b)])
        code = code[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
        groups = b"".join(map(self.names.__getitem__, code.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.name_length[code])])
        n_a, n_b = at_a[last] + 1, at_b[last] + 1
        cuts = ends[n_a + n_b].tolist()
        link_cuts = (4 * (last + 1)).tolist()
        tokens = (np.diff(n_a, prepend=0) << 32 | np.diff(n_b, prepend=0)).tolist()
        g = k = 0
        for chunk, g2, k2, n in zip(chunks, cuts, link_cuts, tokens):
            self.cache[chunk] = (groups[g:g2 - 1], links[k:k2], n)
            g, k = g2, k2
        return True

    def aligned(self, chunk: str, a: list[int], b: list[int]) -> tuple[bytes, bytes, int] | None:
        """(groups as text, links as 32-bit pairs, A tokens << 32 | B tokens); None: bytes differ."""
        parts_a, parts_b = [self.a_bytes[x] for x in a], [self.b_bytes[x] for x in b]
        whole = (" " + chunk).encode()
        if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            return None
        groups, links = [], []
        i = j = begin_i = begin_j = end_a = end_b = 0
        while i < len(a):
            end_a += len(parts_a[i])
            i += 1
            while end_b < end_a:
                end_b += len(parts_b[j])
                j += 1
            if end_a == end_b:
                groups.append(f"{','.join(map(str, a[begin_i:i]))}|{','.join(map(str, b[begin_j:j]))}")
                links.append(a[i - 1] << 15 | b[j - 1])
                begin_i, begin_j = i, j
        return ";".join(groups).encode(), np.array(links, "<u4").tobytes(), len(a) << 32 | len(b)

    def align_all(self, texts: list[bytes | None]) -> list[tuple[bytes, bytes, int] | None]:
        """(groups, links, token counts) of each text; None: no tokens."""
        split: list[list[str] | None] = []
        for raw in texts:
            try:
                split.append(self.chunks(raw.decode()) if raw else None)
            except UnicodeDecodeError:
                split.append(None)
        if len(self.cache) > _CACHE_LIMIT:
            self.cache.clear()
        cache = self.cache
        new = list({c for x in split if x for c in x} - cache.keys())
        self.learn(new)
        out = []
        for x in split:
            parts = [cache[c] for c in x] if x else [None]
            if None in parts:
                out.append(None)
                continue
            groups, links, counts = zip(*parts)
            out.append((b";".join(groups), b"".join(links), sum(counts)))
        return out


_LOADED: dict[int, Aligner] = {}


def loaded(byte_level: bytes, pieces: bytes) -> Aligner:
    key = hash((byte_level, pieces))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(byte_level, pieces)
    return _LOADED[key]


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- bitmaps --------------------------------------------------------------------------------

_DENSE = CONTAINER // 8            # bytes of a plain bitmap; a list is shorter


def _compressed(keys: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(list names, compressed bitmaps) of sorted ``name << 16 | document``."""
    names = keys >> np.uint64(16)
    heads = np.flatnonzero(np.diff(names, prepend=names[0] + np.uint64(1)) != 0) if len(names) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(keys))
    rows = (keys & np.uint64(0xFFFF)).astype("<u2")
    sizes = 2 * (ends - heads)
    dense = np.flatnonzero(sizes >= _DENSE)
    if not len(dense):
        data = rows.tobytes()
    else:
        pieces, at = [], 0
        for d in dense:
            bits = np.zeros(CONTAINER, np.uint8)
            bits[rows[heads[d]:ends[d]]] = 1
            pieces += [rows[at:heads[d]].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
            at, sizes[d] = ends[d], _DENSE
        data = b"".join([*pieces, rows[at:].tobytes()])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return names[heads], pa.BinaryArray.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def members(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(list number, document) of every entry of a column of compressed bitmaps."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if n and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    sizes, start = np.diff(offsets), offsets[:-1] - offsets[0] if n else offsets
    dense = np.flatnonzero(sizes == _DENSE)
    if not len(dense):
        return np.repeat(np.arange(n), sizes // 2), data.view("<u2").astype(np.int64)
    which, rows = [], []
    keep = np.ones(len(data), bool)
    for d in dense:
        bits = np.flatnonzero(np.unpackbits(data[start[d]:start[d] + _DENSE], bitorder="little"))
        keep[start[d]:start[d] + _DENSE] = False
        which.append(np.full(len(bits), d))
        rows.append(bits)
    sizes[dense] = 0
    return (np.concatenate([np.repeat(np.arange(n), sizes // 2), *which]),
            np.concatenate([data[keep].view("<u2").astype(np.int64), *rows]))


def popcount(bitmap: Column) -> Column:
    """Documents of a compressed bitmap."""
    return F.when(F.length(bitmap) == _DENSE, F.bitmap_count(bitmap)).otherwise(F.shiftright(F.length(bitmap), 1).cast("long"))


_TABLE = ("container long, low int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "groups string, a int, b int, docs binary, planes array<binary>")
_TYPES = pa.schema([("container", pa.int64()), ("low", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
                    ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.binary()), ("planes", pa.list_(pa.binary()))])


def _table(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _TYPES], schema=_TYPES)


def _lists(container: int, parts: list[tuple[np.ndarray, np.ndarray]]):
    """Postings of a container: one row a pair."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, more = keys[order], counts[order] - 1
    pairs, docs = _compressed(keys)
    pair, row = keys >> np.uint64(16), keys & np.uint64(0xFFFF)
    planes = []
    for p in range(int(more.max(initial=0)).bit_length()):
        has = (more >> p & 1).astype(bool)
        planes.append(pair[has] << np.uint64(21) | np.uint64(p << 16) | row[has])
    plane_keys = np.sort(np.concatenate(planes)) if planes else np.zeros(0, np.uint64)
    names, bits = _compressed(plane_keys)
    # planes of a pair up to its highest; those that no document has stay empty
    plane, of = (names & np.uint64(31)).astype(np.int64), np.searchsorted(pairs, names >> np.uint64(5))
    height = np.zeros(len(pairs), np.int64)
    np.maximum.at(height, of, plane + 1)
    starts = np.concatenate([[0], np.cumsum(height)])
    index = np.full(starts[-1], -1, np.int64)
    index[starts[of] + plane] = np.arange(len(names))
    filled = bits.take(pa.array(np.where(index < 0, 0, index), mask=index < 0)) if len(names) else pa.array([], pa.binary())
    a, b = (pairs >> np.uint64(15)).astype(np.int32), (pairs & np.uint64(0x7FFF)).astype(np.int32)
    for at in range(0, len(pairs), 20_000):
        z = min(len(pairs), at + 20_000)
        lists = pa.ListArray.from_arrays(pa.array((starts[at:z + 1] - starts[at]).astype(np.int32)), filled[starts[at]:starts[z]])
        yield _table(z - at, container=pa.array(np.full(z - at, container)), a=pa.array(a[at:z]), b=pa.array(b[at:z]),
                     docs=docs[at:z], planes=lists)


def _encode(shared, container_docs: int, postings: int, keep_groups: bool):
    def run(batches):
        aligner = loaded(*shared.value)
        container, low, parts, held = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in slices(batches, min(256, container_docs)):
            if low and (low + batch.num_rows > container_docs or held >= postings):
                if parts:
                    yield from _lists(container, parts)
                container, low, parts, held = container + 1, 0, [], 0
            found = aligner.align_all(batch.column("text").cast(pa.binary()).to_pylist())
            n = len(found)
            lengths = np.array([len(x[1]) // 4 if x else 0 for x in found], np.int64)
            tokens = [x[2] if x else 0 for x in found]
            columns = dict(
                container=pa.array(np.full(n, container)), low=pa.array(np.arange(low, low + n, dtype=np.int32)), doc_id=batch.column(DOC_ID),
                n_a=pa.array([x >> 32 for x in tokens], pa.int64()), n_b=pa.array([x & 0xFFFFFFFF for x in tokens], pa.int64()),
                n_groups=pa.array(lengths), n_links=pa.array(lengths),
                groups_sha256=pa.array([sha256(x[0]).hexdigest() if x else "" for x in found]))
            if keep_groups:
                columns["groups"] = pa.array([x[0].decode() if x else "" for x in found])
            yield _table(n, **columns)
            if lengths.any():
                links = np.frombuffer(b"".join([x[1] for x in found if x]), "<u4").astype(np.uint64)
                rows = np.repeat(np.arange(low, low + n, dtype=np.uint64), lengths)
                parts.append(np.unique(links << np.uint64(16) | rows, return_counts=True))
                held += len(parts[-1][0])
            low += n
        aligner.cache.clear()                # the process lives on for other tasks
        if parts:
            yield from _lists(container, parts)
    return run


# ---- scores ---------------------------------------------------------------------------------

def _returned(batches):
    """Rows sorted by container -> (container, low, n_best, count_sum) of its documents."""
    held, best, total = None, None, None

    def out():
        low = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(low), held)), pa.array(low.astype(np.int32)), pa.array(best[low]),
                                           pa.array(total[low])], names=["container", "low", "n_best", "count_sum"])

    for batch in batches:
        where = batch.column("container").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(where)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            if where[lo] != held:
                if held is not None:
                    yield out()
                held, best, total = int(where[lo]), np.zeros(CONTAINER, np.int64), np.zeros(CONTAINER, np.int64)
            part = batch.slice(lo, hi - lo)
            score, top = part.column("count").to_numpy(), part.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
            i, row = members(part.column("docs"))
            np.add.at(total, row, score[i])
            np.add.at(best, row, top[i])
            lists = part.column("planes")
            flat, sizes = lists.flatten(), lists.value_lengths().to_numpy()
            if len(flat):
                of = np.repeat(np.arange(len(lists)), sizes)
                plane = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                i, row = members(pa.concat_arrays([flat]).fill_null(b""))
                times = np.left_shift(1, plane[i])
                np.add.at(total, row, score[of[i]] * times)
                np.add.at(best, row, top[of[i]] * times)
    if held is not None:
        yield out()


class Alignment:
    """The written table of documents and postings, and what it gives."""

    def __init__(self, table: DataFrame):
        self.table = table

    @property
    def documents(self) -> DataFrame:
        return self.table.filter("a IS NULL").select("container", "low", DOC_ID, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")

    @property
    def postings(self) -> DataFrame:
        return self.table.filter("a IS NOT NULL").select("container", "a", "b", "docs", "planes")

    def pairs(self) -> DataFrame:
        """``a, b, documents, count, best``: of every linked pair of ids, in how many documents and how
        often it is linked, and whether no other A id is linked with this B id more often."""
        links = F.aggregate(F.transform("planes", lambda x, p: F.coalesce(popcount(x), F.lit(0)) * F.pow(F.lit(2.0), p).cast("long")),
                            popcount(F.col("docs")), lambda s, x: s + x)
        counted = (self.postings.select("a", "b", popcount(F.col("docs")).alias("d"), links.alias("n"))
                   .groupBy("a", "b").agg(F.sum("d").alias("documents"), F.sum("n").alias("count")))
        return counted.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))

    def scored(self) -> DataFrame:
        """Documents with ``n_best`` and ``count_sum``."""
        pairs = materialize(self.pairs(), "pairs")
        back = (self.postings.join(pairs, ["a", "b"]).select("container", "docs", "planes", "count", "best")
                .repartition("container").sortWithinPartitions("container")
                .mapInArrow(_returned, "container long, low int, n_best long, count_sum long"))
        return (self.documents.join(back, ["container", "low"], "left")
                .select(DOC_ID, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256", "groups"))


def align(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, id_col: str = DOC_ID, text_col: str = "text",
          keep_groups: bool = False, container_docs: int = CONTAINER, postings: int = POSTINGS) -> Alignment:
    """Both encodings of every whole text, written once.  ``keep_groups``: with the groups themselves
    (``a1,a2|b1;a3|b2``), not only their digest."""
    files = default_vocabularies()
    data = []
    for path in (byte_level or files[0], pieces or files[1]):
        with open(path, "rb") as f:
            data.append(f.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(data))
    d = docs.select(docs[id_col].cast("long").alias(DOC_ID), docs[text_col].alias("text"))
    return Alignment(materialize(d.mapInArrow(_encode(shared, min(container_docs, CONTAINER), postings, keep_groups), _TABLE), "aligned"))
