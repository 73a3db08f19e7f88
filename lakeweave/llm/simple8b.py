"""Simple-8b word-aligned coding of token ids, and files of such words with per-block offsets.

A 64-bit word holds a 4-bit selector (top bits) and 60 payload bits: ``COUNTS[s]`` values of
``BITS[s]`` bits, the first value lowest. Selectors 0 and 1 are runs of zeros. The last selector is
the escape: one value of up to 60 bits. Blocks of ``BLOCK`` ids end at a word's end, so the offset
of a block's first word lets a reader decode any block, or all of them at once, without the rest.

File: magic, words of all blocks (little-endian uint64), then the footer: doc ids (int64), null flags
(uint8), ids per document (int64), words per block (uint32), and three int64: documents, ids, blocks.
"""

from __future__ import annotations

import numpy as np

#: Values in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK = 512
MAGIC = b"LWS8B\x001\x00"


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; exact below 2**53, and rounded up at most above."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int8)


def _fits(widths: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The selector with the most values that all fit, for a word that would begin at each place."""
    n = len(widths)
    best = np.full(n, 15, np.int8)
    peak = {1: widths}
    span = 1
    while span * 2 <= 240:
        longer = peak[span].copy()
        if n > span:
            np.maximum(longer[:-span], peak[span][span:], out=longer[:-span])
        peak[span * 2] = longer
        span *= 2
    for s in range(14, -1, -1):
        c = int(COUNTS[s])
        if c > n:
            continue
        p = 1 << (c.bit_length() - 1)
        worst = peak[p].copy()
        if c > p:
            np.maximum(worst[: n - c + p], peak[p][c - p :], out=worst[: n - c + p])
        best[(worst <= BITS[s]) & (left >= c)] = s
    return best


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, words per block) of ids cut into blocks of BLOCK, the last perhaps shorter."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    ids = ids.astype(np.uint64)
    if int(ids.max()) >> 60:
        raise ValueError("an id of over 60 bits")
    begins = np.arange(0, n, BLOCK)
    left = np.minimum(BLOCK, n - begins).repeat(np.minimum(BLOCK, n - begins)) - (np.arange(n) % BLOCK)
    best = _fits(bit_widths(ids), left)
    step = COUNTS[best]
    at, ends, chain, owner = begins.copy(), np.minimum(begins + BLOCK, n), [], []
    live = np.arange(len(begins))
    while len(live):  # all blocks advance together, a word at a time
        chain.append(at[live])
        owner.append(live)
        at[live] += step[at[live]]
        live = live[at[live] < ends[live]]
    starts, owner = np.concatenate(chain), np.concatenate(owner)
    order = np.argsort(starts, kind="stable")
    starts, owner = starts[order], owner[order]
    words = best[starts].astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        pick = np.flatnonzero(best[starts] == s)
        for k in range(int(COUNTS[s])) if len(pick) else ():
            words[pick] |= ids[starts[pick] + k] << np.uint64(k * int(BITS[s]))
    return words, np.bincount(owner, minlength=len(begins)).astype(np.uint32)


def decode_words(words: np.ndarray) -> np.ndarray:
    """All ids of whole blocks' words, by one pass for each selector."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(2, 16):
        pick = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s])) if len(pick) else ():
            out[at[pick] + k] = (words[pick] >> np.uint64(k * int(BITS[s]))) & mask
    return out


class Writer:
    """Appends documents to an open binary file; memory holds one batch and the footer."""

    def __init__(self, sink):
        self.sink, self.rest = sink, np.zeros(0, np.uint64)
        self.docs, self.nulls, self.sizes, self.blocks, self.total = [], [], [], [], 0
        sink.write(MAGIC)

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids), self.nulls.append(nulls), self.sizes.append(sizes)
        self.total += len(ids)
        ids = np.concatenate((self.rest, ids.astype(np.uint64)))
        cut = len(ids) // BLOCK * BLOCK
        self._put(ids[:cut])
        self.rest = ids[cut:]

    def _put(self, ids: np.ndarray) -> None:
        words, per_block = encode_blocks(ids)
        self.sink.write(words.astype("<u8").tobytes())
        self.blocks.append(per_block)

    def close(self) -> None:
        self._put(self.rest)
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        docs, blocks = join(self.docs, "<i8"), join(self.blocks, "<u4")
        for part in (docs, join(self.nulls, "u1"), join(self.sizes, "<i8"), blocks, np.array([len(docs), self.total, len(blocks)], "<i8")):
            self.sink.write(part.tobytes())
        self.sink.close()


class Reader:
    """Reads a file by its footer, then runs of blocks; ``documents`` yields whole documents in order."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(0)
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        source.seek(size - 24)
        n_docs, self.total, n_blocks = np.frombuffer(source.read(24), "<i8").tolist()
        source.seek(size - 24 - n_docs * 17 - n_blocks * 4)
        self.doc_ids = np.frombuffer(source.read(8 * n_docs), "<i8")
        self.nulls = np.frombuffer(source.read(n_docs), "u1").astype(bool)
        self.sizes = np.frombuffer(source.read(8 * n_docs), "<i8")
        self.words = np.frombuffer(source.read(4 * n_blocks), "<u4")

    def ids(self, blocks: int = 2048):
        """Runs of ids, ``blocks`` blocks at a time."""
        self.source.seek(len(MAGIC))
        for i in range(0, len(self.words), blocks):
            raw = self.source.read(8 * int(self.words[i : i + blocks].sum()))
            yield decode_words(np.frombuffer(raw, "<u8"))

    def block(self, k: int) -> np.ndarray:
        """Block k alone, found by its offset."""
        self.source.seek(len(MAGIC) + 8 * int(self.words[:k].sum()))
        return decode_words(np.frombuffer(self.source.read(8 * int(self.words[k])), "<u8"))
