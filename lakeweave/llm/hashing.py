"""Vectorised word and shingle hashes of whole texts.

A word's hash is a polynomial over its bytes' random values, modulo 2**64, from one prefix sum over the
texts' bytes: no Python object for a word is made. Two different words get the same hash with a
probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lakeweave.llm.common import WS_TABLE, bytes_of

U = np.uint64
_rng = np.random.default_rng(20240607)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_UPPER = np.arange(65, 91)
_VALUE[_UPPER] = _VALUE[_UPPER + 32]  # A-Z hash as a-z
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_MIX = (U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53))
STEPS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(33))
    x *= _MIX[0]
    x ^= x >> U(33)
    x *= _MIX[1]
    x ^= x >> U(33)
    return x


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for later calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        done = 1
        while done < size:  # doubles what is there
            have[done : 2 * done] = have[:done] * U(pow(base, done, 2**64))
            done *= 2
        _powers[base] = have
    return have[:n]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, offsets of each text's words). A-Z count as a-z."""
    data, off = bytes_of(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~WS_TABLE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]  # words end with their text
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    total = np.cumsum(_VALUE[data] * _power(_BASE, len(data)), dtype=np.uint64)
    before = np.where(first > 0, total[first - 1], U(0))
    hashes = (total[last] - before) * _power(_INVERSE, len(data))[first]
    return mix(hashes), np.searchsorted(first, off)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n words, by the place they begin."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1] * STEPS[0]
    for k in range(1, n):
        out += words[k : len(words) - n + 1 + k] * STEPS[k]
    return mix(out + U(n))


def shingle_sets(words: np.ndarray, off: np.ndarray, n: int = 5):
    """For each text its sorted distinct n-word shingle hashes; a shorter text's whole sequence is its one shingle."""
    windows = window_hashes(words, n)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(windows[a : b - n + 1])
        elif b > a:
            yield window_hashes(words[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)
