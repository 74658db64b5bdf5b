"""Token ids of whole texts by a public tokenizer that drops white space, with a bounded word cache.

The tokenizer of ``word_bpe_49k.json`` treats what lies between white space on its own, so a text's
ids are the ids of its white-space separated chunks in order.  Chunks repeat; a task encodes each
new chunk once.  A closing ``.`` or ``,`` after an ASCII letter or digit is always a token of its
own, so it is split off before the lookup.  The vocabulary file travels as bytes with the job: the
executors need the library, not the file.
"""

from __future__ import annotations

import os

import numpy as np

_LOADED: dict[int, "WordTokenizer"] = {}
_CACHE_LIMIT = 200_000           # chunks of a generation
_GROUP = 500                     # new chunks that are encoded as one text


class _Cache(dict):
    """Chunk -> ids.  Asked for a chunk it lacks, it gives an empty buffer, which it notes and which
    is filled later: every chunk of a text is looked up once.  Two generations bound it: a full one
    becomes the old one, from which chunks that are met again move back."""

    def __init__(self):
        super().__init__()
        self.old: dict[bytes, bytearray] = {}
        self.open: dict[bytes, bytearray] = {}

    def __missing__(self, chunk: bytes) -> bytearray:
        buffer = self.old.get(chunk)
        if buffer is None:
            buffer = self.open[chunk] = bytearray()
        self[chunk] = buffer
        return buffer

    def age(self, limit: int) -> None:
        if len(self) > limit:
            self.old = dict(self)
            self.clear()

    def forget(self) -> None:
        self.old = {}
        self.clear()


def _byte_letters() -> str:
    """The printable stand-in of each byte in byte-level vocabularies: visible Latin-1 characters
    stand for themselves, the others for the code points from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in own else next(rest)) for b in range(256))


class WordTokenizer:
    """Encoder of one task process; ``encode_all`` gives little-endian 32-bit ids as bytes."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(data)
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(_byte_letters()))
        self.cache = _Cache()
        self.closing = {b[0]: self._ids([b.decode()])[0] for b in (b".", b",")}
        self.mark = next(w for w in ("\N{PILCROW SIGN}", "\N{SECTION SIGN}", "\N{DEGREE SIGN}")
                         if len(self.tokenizer.encode(w, add_special_tokens=False).ids) == 1)
        self.mark_id = self.tokenizer.encode(self.mark, add_special_tokens=False).ids[0]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _grouped(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that are encoded together, with a one-token mark between them; if a chunk
        has the mark in itself, the counts differ and the chunks are encoded one by one."""
        text = f" {self.mark} ".join(chunks)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == self.mark_id)
        if len(cuts) != len(chunks) - 1:
            return self._ids(chunks)
        return [ids[a:b].tobytes() for a, b in zip([0, *(cuts + 1)], [*cuts, len(ids)])]

    def _word(self, word: str) -> bytes | None:
        """Ids of a lower-case word of letters below U+0250 straight from the model: normalisation
        and splitting leave such a word as it is.  Others: None."""
        if not word.isalpha() or max(word) >= "\u0250" or word != word.lower():
            return None
        stand_in = word.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(stand_in)], "<u4").tobytes()

    def _learn(self) -> None:
        """Fill the open buffers."""
        cache, todo = self.cache, []
        opened, cache.open = cache.open, {}
        for chunk, buffer in opened.items():
            close = b""
            if len(chunk) > 1 and chunk[-1] in self.closing and chunk[-2:-1].isalnum():
                close = self.closing[chunk[-1]]
                chunk = chunk[:-1]
                known = cache.get(chunk)
                if known:
                    buffer += known + close
                    continue
            text = chunk.decode("utf-8", "replace")
            ids = self._word(text)
            if ids is None:
                todo.append((text, buffer, close))
            else:
                buffer += ids + close
        for i in range(0, len(todo), _GROUP):
            part = todo[i:i + _GROUP]
            for (_, buffer, close), ids in zip(part, self._grouped([t for t, _, _ in part])):
                buffer += ids + close

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; special-token strings keep their meaning, so only texts without
        ``<|`` are lower-cased before the lookup."""
        out: list[bytes] = []
        cache = self.cache
        for i in range(0, len(texts), 256):
            cache.age(_CACHE_LIMIT)
            found = [list(map(cache.__getitem__, (t if b"<|" in t else t.lower()).split()))
                     for t in texts[i:i + 256]]
            self._learn()
            out += [b"".join(x) for x in found]
        return out


def loaded(data: bytes) -> WordTokenizer:
    """The process's tokenizer for this vocabulary."""
    key = hash(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordTokenizer(data)
    return _LOADED[key]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
