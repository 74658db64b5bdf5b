"""SentencePiece encoding and decoding by suffix-array matching.

A text falls into segments that no piece crosses (a run of blanks with the word after it).  A task
collects the segments it has not met, indexes their concatenation with a suffix array, finds every
piece's range of occurrences by binary search, sorts the occurrences (edges) by their end, and
relaxes the edges from left to right: of the edges that end at a place, the one that agrees with the
last piece of the text before it continues the encoding.  Places are
settled as the encodings that pass them ask for it.  Two neighbours agree if merging the two
pieces' characters by score gives the two pieces back, which is what makes the path the model's own.
Characters outside the vocabulary become their bytes' pieces.

Defined results
    null or empty text   no ids
    blanks               U+2581 counts as a blank, as in the model
    very long text       whole text; the index holds ``index_chars`` characters at a time, and a run
                         without blank that is longer is indexed in windows that overlap by a piece
    ties                 merges of equal score: the leftmost first
    repeated rows        each encoded
    empty table          empty result
    extra columns        only id and text are read
"""

from __future__ import annotations

import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapflow.llm.common import DOC_ID, narrow

BLANK = "▁"
_CACHE_LIMIT = 600_000
_PAIR_LIMIT = 1_000_000


class Model:
    """Vocabulary of a SentencePiece BPE model with byte fallback and blank prefix."""

    def __init__(self, data: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = sp.get_piece_size()
        self.bytes_id = {}
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.raw: list[bytes] = [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes_id[value] = i
                self.raw[i] = bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.id_of[piece] = i
                self.score[piece] = sp.get_score(i)
                self.raw[i] = piece.replace(BLANK, " ").encode()
        self.longest = max(map(len, self.id_of))
        self.pieces = sorted(self.id_of)
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.pieces):
            raise ValueError("a piece crosses a segment's end: this model needs other segments")
        letters = sorted({c for p in self.pieces for c in p})
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        self.patterns_low = self._keys([p for p in self.pieces], 0)
        self.patterns_high = self._keys([p for p in self.pieces], 0xFFFF)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.standing = np.array([self.merged(list(p)) == [p] for p in self.pieces])
        self.symbols = list(self.pieces)                   # pieces, then characters without one
        self.symbol_of: dict[str, int] = {}
        self.length_of = [len(p) for p in self.pieces]
        self.data_of = [np.array([self.id_of[p]], "<u4").tobytes() for p in self.pieces]
        self.agrees: dict[int, bool] = {}
        inside = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
        #: closing mark -> letters after which no piece holds it: there a segment can be cut
        self.closes = {ord(m): {ord(c) for c in letters if c + m not in inside} for m in ".,;:!?" if m in self.id_of}

    def ranks(self, chars: np.ndarray) -> np.ndarray:
        """Rank of each character among those of the pieces, from 2; 1: another character."""
        at = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        return np.where(self.letters[at] == chars, at + 2, 1).astype(np.uint16)

    def _keys(self, texts: list[str], pad: int) -> np.ndarray:
        """Fixed-width sort keys of texts, padded with a lowest or highest character."""
        out = np.full((len(texts), self.longest), pad, np.uint16)
        for i, t in enumerate(texts):
            out[i, :len(t)] = self.ranks(np.array([ord(c) for c in t], np.uint32))
        return _as_keys(out)

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge neighbours by score, the leftmost of equal ones first, until none fits."""
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def symbol(self, char: str) -> int:
        """Number of a character that no edge covers, after those of the pieces."""
        known = self.symbol_of.get(char)
        if known is None:
            known = self.symbol_of[char] = len(self.symbols)
            self.symbols.append(char)
            self.length_of.append(1)
            self.data_of.append(np.array(self.fallback(char), "<u4").tobytes())
        return known

    def agree(self, a: int, b: int) -> bool:
        if len(self.agrees) >= _PAIR_LIMIT:
            self.agrees.clear()
        x, y = self.symbols[a], self.symbols[b]
        known = self.agrees[a << 24 | b] = self.merged(list(x + y)) == [x, y]
        return known

    def joined(self, a: int, b: int) -> bool:
        known = self.agrees.get(a << 24 | b)
        return self.agree(a, b) if known is None else known

    def fallback(self, char: str) -> list[int]:
        return [self.bytes_id[b] for b in char.encode("utf-8", "replace")]


def _as_keys(ranks: np.ndarray) -> np.ndarray:
    """Rows of 16-bit ranks as byte strings that sort like the rows."""
    rows = np.ascontiguousarray(ranks.astype(">u2"))
    return rows.view(f"S{rows.shape[1] * 2}").ravel()


def suffix_edges(model: Model, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, length, piece number) of every occurrence of every piece, sorted by end, longest first.

    The suffix array is cut at the longest piece: no search looks further."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    ranks = np.concatenate([model.ranks(chars), np.zeros(model.longest, np.uint16)])
    windows = np.lib.stride_tricks.sliding_window_view(ranks, model.longest)[:len(chars)]
    keys = _as_keys(windows)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    low = np.searchsorted(keys, model.patterns_low, "left")
    high = np.searchsorted(keys, model.patterns_high, "right")
    count = np.maximum(high - low, 0)
    count[~model.standing] = 0
    piece = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    start = order[np.repeat(low, count) + within]
    length = model.lengths[piece]
    end = start + length
    by = np.lexsort((-length, end))
    return end[by], length[by], piece[by]


def encode_long(model: Model, segment: str, index_chars: int) -> bytes:
    """Ids of one long segment.  Windows of ``index_chars`` characters, each with the longest piece's
    length before it, are indexed and settled from left to right; only the piece that ends at each
    place is kept, in four bytes."""
    from array import array
    n = len(segment)
    last = array("i", [-1]) * (n + 1)
    for begin in range(0, n, index_chars):
        low, high = max(0, begin - model.longest), min(n, begin + index_chars)
        end, length, piece = suffix_edges(model, segment[low:high])
        first = np.searchsorted(end, np.arange(high - low + 2)).tolist()
        length, piece = length.tolist(), piece.tolist()
        for at in range(begin + 1, high + 1):
            for e in range(first[at - low], first[at - low + 1]):
                start = at - length[e]
                if start == 0 or model.joined(last[start], piece[e]):
                    last[at] = piece[e]
                    break
            else:
                last[at] = model.symbol(segment[at - 1])
    out, at = bytearray(), n
    while at:                                 # backwards, four bytes an id
        b = last[at]
        out += model.data_of[b][::-1]
        at -= model.length_of[b]
    return np.frombuffer(bytes(out), ">u4")[::-1].astype("<u4").tobytes()


def encode_segments(model: Model, segments: list[str]) -> list[bytes]:
    """Little-endian 32-bit ids of each segment (blanks already as U+2581)."""
    gap = "\x00"
    text = gap.join(segments) + gap
    end, length, piece = suffix_edges(model, text)
    n = len(text)
    first = np.searchsorted(end, np.arange(n + 2)).tolist()
    length, piece = length.tolist(), piece.tolist()
    agree, known_agree = model.agree, model.agrees.get
    last = [-1] * (n + 1)                     # last piece of the encoding that ends at a place

    def relax(at: int, begin: int) -> int:
        """Settle the place ``at`` of a segment that starts at ``begin``."""
        for e in range(first[at], first[at + 1]):
            b, start = piece[e], at - length[e]
            if start == begin:
                last[at] = b
                return b
            a = last[start]
            if a < 0:
                a = relax(start, begin)
            known = known_agree(a << 24 | b)
            if known or (known is None and agree(a, b)):
                last[at] = b
                return b
        b = last[at] = model.symbol(text[at - 1])        # a character without a piece
        return b

    out, begin = [], 0
    data_of, length_of = model.data_of, model.length_of
    for seg in segments:
        stop = begin + len(seg)
        if len(seg) > 100:                    # settle every place in turn: no deep recursion
            for at in range(begin + 1, stop):
                if last[at] < 0:
                    relax(at, begin)
        ids, at = [], stop
        while at > begin:
            b = last[at]
            if b < 0:
                b = relax(at, begin)
            ids.append(data_of[b])
            at -= length_of[b]
        ids.reverse()
        out.append(b"".join(ids))
        begin = stop + 1
    return out


class _Cache(dict):
    def __init__(self):
        super().__init__()
        self.open: dict[bytes, bytearray] = {}

    def __missing__(self, chunk: bytes) -> bytearray:
        self[chunk] = self.open[chunk] = buffer = bytearray()
        return buffer


_BLANK_BYTES = BLANK.encode()
_SPACED = re.compile(rb" *[^ ]+| +$")


class Encoder:
    """Encoder of one task process with a bounded cache of segments."""

    def __init__(self, data: bytes, index_chars: int = 200_000):
        self.model, self.index_chars, self.cache = Model(data), index_chars, _Cache()

    @staticmethod
    def chunks(text: bytes) -> list[bytes]:
        """Cache keys of the segments: a word after one blank is the word; a line break opens a
        segment without blank; any other segment carries its blanks."""
        if not text:
            return []
        text = text.replace(_BLANK_BYTES, b" ")
        split = text.replace(b"\n", b" \n")
        if b"  " in split or split[:1] == b" " or split[-1:] == b" ":
            return [b" " + s if s[:1] != b"\n" else s
                    for line in [b" " + text] for part in re.split(rb"(?=\n)", line) for s in _SPACED.findall(part)]
        return split.split(b" ")

    @staticmethod
    def _segment(key: bytes) -> str:
        if key[:1] == b" ":
            s = key[1:]
        elif key[:1] == b"\n":
            s = key
        else:
            s = b" " + key
        return s.decode("utf-8", "replace").replace(" ", BLANK)

    def _learn(self) -> None:
        """Fill the open buffers; a closing mark that no piece joins to its letter is set aside."""
        cache, closes, ids_of = self.cache, self.model.closes, self.model.id_of
        opened, cache.open = cache.open, {}
        todo: dict[bytes, list] = {}
        for key, buffer in opened.items():
            close = b""
            if len(key) > 1 and key[-2] in closes.get(key[-1], ()):
                close = np.array([ids_of[chr(key[-1])]], "<u4").tobytes()
                key = key[:-1]
                known = cache.get(key)
                if known:
                    buffer += known + close
                    continue
            todo.setdefault(key, []).append((buffer, close))
        for key in [k for k in todo if len(k) > self.index_chars]:
            data = encode_long(self.model, self._segment(key), self.index_chars)
            for buffer, close in todo.pop(key):
                buffer += data + close
        keys, at = list(todo), 0
        while at < len(keys):
            part, chars = [], 0
            while at < len(keys) and (not part or chars < self.index_chars):
                part.append(self._segment(keys[at]))
                chars += len(part[-1])
                at += 1
            for key, data in zip(keys[at - len(part):at], encode_segments(self.model, part)):
                for buffer, close in todo[key]:
                    buffer += data + close

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out: list[bytes] = []
        for i in range(0, len(texts), 512):
            if len(self.cache) > _CACHE_LIMIT:
                self.cache.clear()
            found = [list(map(self.cache.__getitem__, self.chunks(t))) for t in texts[i:i + 512]]
            self._learn()
            out += [b"".join(x) for x in found]
        return out

    def decode(self, ids: bytes) -> bytes:
        """Text of ids; the blank before the first word goes, broken bytes become U+FFFD."""
        raw = b"".join(map(self.model.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        raw = raw[1:] if raw[:1] == b" " else raw
        return raw.decode("utf-8", "replace").encode()


_LOADED: dict[int, Encoder] = {}


def loaded(data: bytes) -> Encoder:
    key = hash(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(data)
    return _LOADED[key]


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


_ROWS = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean, ids binary"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()),
                     ("decoded_sha256", pa.string()), ("round_trip", pa.bool_()), ("ids", pa.binary())])


def _encode(shared, width: str):
    def run(batches):
        encoder = loaded(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                ids = encoder.encode_all(texts)
                back = [encoder.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([sha256(x).hexdigest() for x in back]),
                    pa.array([a == b for a, b in zip(texts, back)]),
                    pa.array([np.frombuffer(x, "<u4").astype(width).tobytes() for x in ids], pa.binary())], schema=_SCHEMA)
    return run


def encoded(docs: DataFrame, model: str | None = None, width: str = "<u2", id_col: str = DOC_ID,
            text_col: str = "text") -> DataFrame:
    """Ids of each whole text (``ids``: little-endian numbers of type ``width``; the checksum is of
    32-bit ids) and the digest of the text that decoding gives back."""
    with open(model or default_model(), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    d = narrow(docs, id_col, text_col).withColumn(DOC_ID, F.col(DOC_ID).cast("long"))
    return d.mapInArrow(_encode(shared, width), _ROWS)
