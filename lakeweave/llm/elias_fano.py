"""Elias-Fano coding of monotone sequences, searched by many values at once, in memory-mapped arrays."""

from __future__ import annotations

import json

import numpy as np

U = np.uint64
#: For each byte value and r, the place of its r-th set bit (8 if there is none).
_ONES, _TOPS = U(0x0101010101010101), U(0x8080808080808080)
_PLACE = np.full((256, 9), 8, np.uint8)
for _v in range(256):
    for _r, _b in enumerate([b for b in range(8) if _v >> b & 1]):
        _PLACE[_v, _r] = _b


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits, packed into 64-bit words, with one word to spare."""
    out = [np.zeros(0, np.uint8)]
    bits = np.arange(width, dtype=np.uint64)
    for at in range(0, len(values) if width else 0, 1 << 16):
        part = values[at : at + (1 << 16)]
        out.append(np.packbits(((part[:, None] >> bits) & U(1)).astype(np.uint8).ravel(), bitorder="little"))
    raw = np.concatenate(out)
    return np.concatenate((raw, np.zeros(-len(raw) % 8 + 8, np.uint8))).view(np.uint64)


class EliasFano:
    """A non-decreasing sequence of unsigned integers below ``universe``."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros, self.ones = n, low_bits, low, high, zeros, ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (universe // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        top = (values >> U(width)).astype(np.int64)
        size = n + (universe >> width) + 2
        bits = np.zeros(size + (-size % 64), np.uint8)
        bits[top + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        count = np.bitwise_count(high).astype(np.int64)
        before = np.concatenate(([0], np.cumsum(count)))
        zeros = 64 * np.arange(len(high) + 1) - before
        kind = np.uint32 if len(bits) < 2**32 else np.uint64
        return cls(n, width, _pack(values & U((1 << width) - 1), width), high, zeros.astype(kind), before.astype(kind))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "zeros": self.zeros, "ones": self.ones, "shape": np.array([self.n, self.low_bits], np.int64)}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], prefix: str) -> EliasFano:
        n, width = arrays[prefix + "shape"].tolist()
        return cls(n, width, *(arrays[prefix + k] for k in ("low", "high", "zeros", "ones")))

    def _select(self, k: np.ndarray, directory: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th set (or, flipped, unset) bit of the high part."""
        word = np.searchsorted(directory, k.astype(directory.dtype), "right") - 1
        rest = (k - directory[word].astype(np.int64)).astype(np.uint64)
        bits = ~self.high[word] if flip else self.high[word]
        # Each byte of ``sums`` holds the set bits up to and with that byte of the word.
        sums = bits - ((bits >> U(1)) & U(0x5555555555555555))
        sums = (sums & U(0x3333333333333333)) + ((sums >> U(2)) & U(0x3333333333333333))
        sums = ((sums + (sums >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * _ONES
        at = np.bitwise_count((((rest * _ONES) | _TOPS) - sums) & _TOPS).astype(np.uint64) << U(3)
        rest -= ((sums << U(8)) >> at) & U(255)
        return 64 * word + at.astype(np.int64) + _PLACE[(bits >> at) & U(255), rest]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = shift + U(self.low_bits) > U(64)
        value = np.where(over, value | (self.low[word + 1] << ((U(64) - shift) & U(63))), value)
        return value & U((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        if not len(i):
            return np.zeros(0, np.uint64)
        top = self._select(i, self.ones, False) - i
        return top.astype(np.uint64) << U(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value >= x, whether it is x), for many x below the universe."""
        if not self.n or not len(x):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        x = x.astype(np.uint64)
        top, want = (x >> U(self.low_bits)).astype(np.int64), x & U((1 << self.low_bits) - 1)
        edges = self._select(np.concatenate((np.maximum(top - 1, 0), top)), self.zeros, True)
        lo, hi = np.where(top > 0, edges[: len(x)] + 1 - top, 0), edges[len(x) :] - top
        end = hi.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):  # binary search within the bucket
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < want[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        hit = lo < end
        hit[hit] = self._low(lo[hit]) == want[hit]
        return lo, hit


def save(sink, arrays: dict[str, np.ndarray]) -> None:
    """Arrays after a JSON header of their names, kinds and places; each begins at a multiple of 64."""
    at, head = 0, {}
    for name, a in arrays.items():
        head[name] = (a.dtype.str, len(a), at)
        at += a.nbytes + (-a.nbytes % 64)
    raw = json.dumps(head).encode()
    raw += b" " * (-(len(raw) + 8) % 64)
    sink.write(len(raw).to_bytes(8, "little") + raw)
    for a in arrays.values():
        sink.write(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 64))
    sink.close()


def load(fs, path: str) -> dict[str, np.ndarray]:
    """Arrays of a saved file: mapped where the file system is a mounted one, else read."""
    from pyarrow.fs import LocalFileSystem

    if isinstance(fs, LocalFileSystem):
        data = np.memmap(path, np.uint8, "r")
    else:
        with fs.open_input_file(path) as source:
            data = np.frombuffer(source.read(), np.uint8)
    size = int.from_bytes(data[:8].tobytes(), "little")
    head = json.loads(data[8 : 8 + size].tobytes())
    return {name: data[8 + size + at : 8 + size + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in head.items()}
