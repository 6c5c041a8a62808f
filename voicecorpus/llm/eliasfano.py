"""Elias-Fano sequences in numpy: built once, saved as plain arrays, memory-mapped and
searched for many queries at once."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


_L1, _L2, _L4, _L8, _H8 = (np.uint64(int(x * 8, 16)) for x in ("55", "33", "0f", "01", "80"))
_IN_BYTE = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[r] for r in range(8)] for b in range(256)], np.int64).ravel()


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` (from 0) in each word: sums of bits up to each
    byte side by side, the first byte whose sum passes the rank, then a table."""
    rank = rank.astype(np.uint64)
    s = word - ((word >> np.uint64(1)) & _L1)
    s = (s & _L2) + ((s >> np.uint64(2)) & _L2)
    s = ((s + (s >> np.uint64(4))) & _L4) * _L8
    below = ((rank * _L8 | _H8) - s) & _H8
    shift = np.bitwise_count(below).astype(np.uint64) << np.uint64(3)
    before = ((s << np.uint64(8)) >> shift) & np.uint64(0xFF)
    byte = (word >> shift) & np.uint64(0xFF)
    return shift.astype(np.int64) + _IN_BYTE[(byte * np.uint64(8) + rank - before).astype(np.int64)]


class EliasFano:
    """A monotone sequence: low bits in an array of whole bytes, high bits in unary, with the
    number of ones and of zeros before each word of these."""

    FIELDS = ("low", "high", "ones", "zeros", "meta")

    def __init__(self, low, high, ones, zeros, meta):
        self.low, self.high, self.ones, self.zeros = low, high, ones, zeros
        self.n, self.bits = int(meta[0]), int(meta[1])

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        want = max(0, (top // max(1, n)).bit_length() - 3)
        bits = next(b for b in (0, 8, 16, 32, 64) if b >= want or b == 64)
        bits = min(bits, 32)
        low = (v & np.uint64((1 << bits) - 1)).astype({0: np.uint8, 8: np.uint8, 16: np.uint16, 32: np.uint32}[bits])
        at = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = (int(at[-1]) if n else 0) // 64 + 2
        high = np.zeros(size, np.uint64)
        word, bit = at >> 6, _ONE << (at & 63).astype(np.uint64)
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if n else np.zeros(0, np.int64)
        if n:
            high[word[first]] = np.bitwise_or.reduceat(bit, first)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64)))).astype(np.int64)
        zeros = np.arange(size + 1) * 64 - ones
        kind = np.uint32 if size * 64 < 1 << 32 else np.int64
        return cls(low if bits else low[:0], high, ones.astype(kind), zeros.astype(kind), np.array([n, bits], np.int64))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ones": self.ones, "zeros": self.zeros, "meta": np.array([self.n, self.bits], np.int64)}

    def _select(self, count: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(count, k.astype(count.dtype), "right") - 1  # fastest for sorted k
        bits = self.high[word]
        return word * 64 + _select_in_word(~bits if flip else bits, k - count[word].astype(np.int64))

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at ``i``."""
        high = (self._select(self.ones, i, False) - i).astype(np.uint64)
        return high if not self.bits else (high << np.uint64(self.bits)) | self.low[i].astype(np.uint64)

    def find(self, lo: np.ndarray, hi: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Index of ``v`` in [lo, hi) of the sequence, or -1: its high part's bucket between two
        zeros, then a search of that bucket's low bits."""
        out = np.full(len(v), -1, np.int64)
        v = v.astype(np.uint64)
        h = (v >> np.uint64(self.bits)).astype(np.int64)
        ok = np.flatnonzero((lo < hi) & (h < int(self.zeros[-1]) - 1))
        if not len(ok):
            return out
        h, v, lo, hi = h[ok], v[ok], lo[ok], hi[ok]
        a = np.where(h > 0, self._select(self.zeros, np.maximum(h - 1, 0), True) + 1, 0) - h
        b = self._select(self.zeros, h, True) - h
        a, b = np.maximum(a, lo), np.minimum(b, hi)
        want = (v & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        if self.bits:
            end = b.copy()
            while True:  # least index in [a, b) whose low bits are at least wanted
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    break
                mid = (a[open_] + b[open_]) >> 1
                less = self.low[mid].astype(np.int64) < want[open_]
                a[open_] = np.where(less, mid + 1, a[open_])
                b[open_] = np.where(less, b[open_], mid)
            hit = np.flatnonzero(a < end)
            hit = hit[self.low[a[hit]].astype(np.int64) == want[hit]]
        else:
            hit = np.flatnonzero(a < b)
        out[ok[hit]] = a[hit]
        return out

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(np.asarray(self.high).view(np.uint8), bitorder="little"))
        high = (at - np.arange(self.n)).astype(np.uint64)
        return high if not self.bits else (high << np.uint64(self.bits)) | self.low.astype(np.uint64)
