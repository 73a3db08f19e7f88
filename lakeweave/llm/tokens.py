"""Whole-text encoding by the tokenizers library, with one library call for each distinct piece.

Both vocabularies used here split text so that no piece spans the end of a run of non-space
characters: a chunk (a run of white space and the run of other characters after it) gets the same
ids wherever it stands. Texts are cut into chunks with numpy, chunks are dictionary-encoded, and only
chunks that a bounded cache doesn't hold go to the library's model. Texts where that rule could fail
(they spell a special token, or have wide white space directly before an ASCII space) are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from lakeweave.llm.common import WS_TABLE, byte_slices, bytes_of, offsets_of

#: Unicode White_Space beyond ASCII.
WIDE_SPACE = "\x85\xa0\u1680\u2000\x2d\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE_THEN_ASCII = re.compile(f"[{WIDE_SPACE}][ \t-\r]")
_WIDE_BYTES = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
#: The patterns of the two vocabulary files, white space spelled out.
_SPACE = f"\t-\r {WIDE_SPACE}"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+"
BYTE_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
#: Longest chunk, in bytes, that the cache keeps.
MAX_KEY = 64


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return [table[b] for b in range(256)]


def lower_all(text: str) -> str:
    """Character-wise lower case; str.lower() alone would turn a final sigma by context."""
    return text.lower() if text.isascii() else text.replace("Σ", "σ").lower()


class ChunkEncoder:
    """Ids of many texts. ``cache``: chunks kept in each of two generations (bounded memory)."""

    def __init__(self, path: str, cache: int = 300_000):
        import regex
        from tokenizers import Tokenizer

        config = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.words = config.get("normalizer") is not None
        self.pattern = regex.compile(WORD_PATTERN if self.words else BYTE_PATTERN)
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.special = [t["content"].encode() for t in config.get("added_tokens", [])]
        self.limit, self.hot, self.old, self.pieces = cache, {}, {}, {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            spelled = piece.encode().decode("latin-1").translate(self.letters)
            found = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if len(self.pieces) >= self.limit:
                self.pieces.clear()
            if len(piece) <= MAX_KEY:
                self.pieces[piece] = found
        return found

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.words:
            text = lower_all(text if text.isascii() else unicodedata.normalize("NFC", text))
            if (word := text.strip(" \n")).isalpha():
                return self._piece(word)
        elif text[:1] == " " and text[1:].isalpha():
            return self._piece(text)
        return b"".join(map(self._piece, self.pattern.findall(text)))

    def _distinct(self, chunks: list[bytes]) -> list[bytes]:
        hot, old = self.hot, self.old
        out = list(map(hot.get, chunks))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            c = chunks[i]
            ids = old.get(c)
            if ids is None:
                ids = self._chunk(c)
            if len(c) <= MAX_KEY:
                hot[c] = ids
            out[i] = ids
        if len(hot) > self.limit:
            self.old, self.hot = hot, {}
        return out

    def _odd(self, text: bytes) -> bool:
        return any(s in text for s in self.special) or any(w in text for w in _WIDE_BYTES) and bool(_WIDE_THEN_ASCII.search(text.decode()))

    def _whole(self, raw: bytes) -> np.ndarray:
        return np.array(self.library.encode(raw.decode(), add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, uint32 ids) of a large_string array without nulls."""
        data, off = bytes_of(texts)
        n = len(texts)
        if not len(data):
            return np.zeros(n + 1, np.int64), np.zeros(0, np.uint32)
        space = WS_TABLE[data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[off[:-1][off[:-1] < len(data)]] = True
        at = np.flatnonzero(begins)
        first = np.searchsorted(at, off)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        ids = self._distinct(chunks.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        lists = pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))), pa.array(np.frombuffer(b"".join(ids), np.uint32)))
        taken = lists.take(chunks.indices)
        ends = offsets_of(taken)[first]
        out = taken.values.to_numpy()
        ends, out = ends - ends[0], out[ends[0] : ends[-1]]
        raw = data.tobytes()
        if any(s in raw for s in (*self.special, *_WIDE_BYTES)):
            odd = [i for i in range(n) if self._odd(raw[off[i] : off[i + 1]])]
            if odd:
                parts = [out[ends[i] : ends[i + 1]] for i in range(n)]
                for i in odd:
                    parts[i] = self._whole(raw[off[i] : off[i + 1]])
                ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
                out = np.concatenate(parts)
        return ends, out

    def encode_column(self, column: pa.Array, most: int = 10 << 20):
        """(first row, offsets, ids) for slices of bounded bytes; nulls count as empty texts."""
        for at, part in byte_slices(column, most):
            yield at, *self.encode(part)


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process and vocabulary."""
    return ChunkEncoder(path)
