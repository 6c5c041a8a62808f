"""Vectorised word splitting and hashing over Arrow string columns.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D after A-Z is
lower-cased; every other byte, including all of UTF-8's multi-byte sequences,
belongs to a word.  Everything here works on a bounded slice of a batch (see
``slices``), so a worker's memory does not follow the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null has length zero."""
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    _, off, data = col.buffers()
    kind = np.int64 if large else np.int32
    if off is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each (one row at least)."""
    _, off = buffers(col)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, len(col))
        lo = hi


@dataclass
class Words:
    """``buf``: a document's words joined by single spaces, padded by 8 bytes.
    ``start``/``end``: each word's place there; ``doc``: its row; ``first``: each
    row's first word, with the number of all words at the end."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.first) - 1


def words(col: pa.Array, lower: bool = True) -> Words:
    raw, off = buffers(col)
    if lower:
        raw = LOWER[raw]
    space = _SPACE[raw]
    head = np.zeros(len(raw) + 1, bool)  # a row begins here
    head[off] = True
    begins = ~space
    begins[1:] &= space[:-1] | head[1:-1]
    ends = ~space
    ends[:-1] &= space[1:] | head[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    doc = np.searchsorted(off, start, "right") - 1
    keep = ~space
    keep[1:] |= ~space[:-1]  # one separator after each word
    place = np.cumsum(keep)
    buf = np.where(space, np.uint8(32), raw)[keep]
    shift = lambda at: np.concatenate(([0], place))[at]
    first = np.searchsorted(doc, np.arange(len(col) + 1))
    return Words(np.concatenate((buf, np.zeros(8, np.uint8))), shift(start), shift(end), doc, first)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of ``size`` words; a shorter row is one
    shingle, a row without words has none."""
    n = np.diff(w.first)
    if not len(w.start):
        return w.start, w.end, w.doc
    last = np.minimum(np.arange(len(w.start)) + size - 1, w.first[1:][w.doc] - 1)
    full = np.arange(len(w.start)) + size <= w.first[1:][w.doc]
    short = (n[w.doc] < size) & (np.arange(len(w.start)) == w.first[:-1][w.doc])
    at = np.flatnonzero(full | short)
    return w.start[at], w.end[last[at]], w.doc[at]


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane):
    return _rot(acc + lane * _P2, 31) * _P1


def xxh64(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42, longest: int = 512) -> np.ndarray:
    """XXH64 of ``buf[start:end]`` for each pair; ``buf`` is padded by 8 bytes."""
    out = np.zeros(len(start), np.uint64)
    if not len(start):
        return out
    size = end - start
    buf = np.ascontiguousarray(buf)
    lane64 = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    lane32 = np.ndarray((len(buf) - 3,), "<u4", buf, 0, (1,))
    order = np.argsort(size, kind="stable")
    sizes, at = np.unique(size[order], return_index=True)
    at = np.append(at, len(order))
    s = np.uint64(seed)
    with np.errstate(over="ignore"):
        for k, n in enumerate(sizes.tolist()):
            rows = order[at[k] : at[k + 1]]
            if n > longest:
                view = memoryview(buf)
                for r in rows.tolist():
                    out[r] = xxhash.xxh64_intdigest(view[start[r] : end[r]], seed)
                continue
            a = start[rows]
            p = 0
            if n >= 32:
                v = [np.full(len(a), x, np.uint64) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
                while p + 32 <= n:
                    for i in range(4):
                        v[i] = _round(v[i], lane64[a + (p + 8 * i)])
                    p += 32
                h = _rot(v[0], 1) + _rot(v[1], 7) + _rot(v[2], 12) + _rot(v[3], 18)
                for x in v:
                    h = (h ^ _round(np.uint64(0), x)) * _P1 + _P4
            else:
                h = np.full(len(a), s + _P5, np.uint64)
            h = h + np.uint64(n)
            while p + 8 <= n:
                h = _rot(h ^ _round(np.uint64(0), lane64[a + p]), 27) * _P1 + _P4
                p += 8
            if p + 4 <= n:
                h = _rot(h ^ (lane32[a + p].astype(np.uint64) * _P1), 23) * _P2 + _P3
                p += 4
            while p < n:
                h = _rot(h ^ (buf[a + p].astype(np.uint64) * _P5), 11) * _P1
                p += 1
            h ^= h >> np.uint64(33)
            h *= _P2
            h ^= h >> np.uint64(29)
            h *= _P3
            h ^= h >> np.uint64(32)
            out[rows] = h
    return out
