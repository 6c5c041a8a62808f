"""Pack documents into sequences of at most ``capacity`` tokens, by swap-based local search.

Tokens are made where the text is; what moves on is one short row for each piece.  Pieces
are dealt evenly to tasks of about ``task_pieces``, each of which packs its own: best fit
decreasing first, then a local search that takes the emptiest bin and moves a document
out of it, or exchanges one for one, two for one or one for two with another underfull
bin, each time so that the sum of squared fills grows, until the bin is empty or nothing
helps.  A task's pieces are a bounded number, so its loss is a bin or so however large the
corpus is.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut

CAPACITY, END_ID, VOCABULARY, TASK_PIECES, SPECIAL = 1024, 2, "byte_bpe_50k", 25_000, "<|endoftext|>"


@lru_cache(4)
def _encoders(vocabulary: str, folder: str | None):
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    place = (lambda name: os.path.join(folder, name)) if folder else public_tokenizers.path
    with open(place(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list = []

    def exact(text: str) -> list[int]:
        if not slow:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            slow.append(Tokenizer.from_file(place(f"{vocabulary}.json")))
        return slow[0].encode(text, add_special_tokens=False).ids

    return fast.encode_ordinary, exact


def encode(text: str, vocabulary: str = VOCABULARY, folder: str | None = None) -> list[int]:
    """The ids that ``tokenizers`` gives for the vocabulary's JSON file.  The same vocabulary
    as ranks is five times faster; it serves texts of Latin letters without a special token's
    string, on which the two can't differ in how they class characters."""
    fast, exact = _encoders(vocabulary, folder)
    if (text.isascii() or max(text) < "ɐ") and SPECIAL not in text:
        return fast(text)
    return exact(text)


def cut_points(n: int, capacity: int = CAPACITY) -> list[int]:
    """Starts of a document's pieces and its end: full pieces, a shorter one first."""
    return [0, *range(n % capacity or min(n, capacity), n + 1, capacity)] if n > capacity else [0, n]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY, folder: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row's pieces."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                rows: list[tuple] = []
                for doc_id, text in zip(b.column(0).slice(lo, 512).to_pylist(), b.column(1).slice(lo, 512).to_pylist(), strict=True):
                    ids = np.array([*encode(text or "", vocabulary, folder), end_id], "<u4")
                    at = cut_points(len(ids), capacity)
                    for i, (a, z) in enumerate(zip(at, at[1:], strict=False)):
                        row = (doc_id, i, a, z - a, zlib.crc32(ids[a:z].tobytes()))
                        rows.append((*row, ids[a:z].astype(np.int32)) if keep_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


class Bins:
    """Bins of pieces (indices into ``size``) under one capacity."""

    def __init__(self, size: list[int], capacity: int):
        self.size, self.capacity = size, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []

    def best_fit(self) -> None:
        """Each piece, largest first, into the fullest bin that has room for it."""
        by_room = {r: [] for r in range(1 + self.capacity)}
        some = 0  # bit r: a bin has room r
        for i in sorted(range(len(self.size)), key=lambda i: -self.size[i]):
            n = self.size[i]
            fit = some >> n
            if fit and n:
                r = n + (fit & -fit).bit_length() - 1
                b = by_room[r].pop()
                if not by_room[r]:
                    some &= ~(1 << r)
                self.bins[b].append(i)
            else:
                b, r = len(self.bins), self.capacity
                self.bins.append([i])
                self.room.append(r)
            r -= n
            self.room[b] = r
            if r:
                by_room[r].append(b)
                some |= 1 << r

    def search(self, pairs: int = 8) -> None:
        """The local search.  ``pairs``: two-piece exchanges look at that many pieces of a bin."""
        cap, size, bins, room = self.capacity, self.size, self.bins, self.room
        age = [0] * len(bins)
        # what a bin could take instead of what it gives (nothing, one or two pieces): by largest
        offers = {t: [] for t in range(1 + cap)}
        some = 0

        def offer(b: int) -> None:
            nonlocal some
            if not room[b] or not bins[b]:
                return
            for give in self._choices(b, pairs, True):
                t = sum(size[i] for i in give) + room[b]
                offers[t].append((b, age[b], give))
                some |= 1 << t

        def taker(a: int, n: int):
            """The tightest valid offer of another bin for n tokens, giving fewer."""
            nonlocal some
            t = n
            while t <= cap and some >> t:
                step = some >> t
                t += (step & -step).bit_length() - 1
                stack = offers[t]
                seen = []
                found = None
                while stack:
                    o = stack.pop()
                    if age[o[0]] != o[1]:
                        continue
                    seen.append(o)
                    given = sum(size[i] for i in o[2])
                    # fuller afterwards than the bin it came from was: the squares grow
                    if o[0] != a and given < n and cap - room[o[0]] + n - given > cap - room[a]:
                        found = o
                        break
                    if len(seen) >= 16:
                        break
                stack.extend(reversed(seen))
                if not stack:
                    some &= ~(1 << t)
                if found:
                    return found
                t += 1
                if t - n > 64:  # far looser than any exchange that fills a bin
                    return None
            return None

        under = sorted((b for b in range(len(bins)) if room[b]), key=lambda b: -room[b])
        for b in under:
            offer(b)
        for a in under:
            while bins[a]:
                best = None
                for take in self._choices(a, pairs, False):
                    n = sum(size[i] for i in take)
                    o = taker(a, n)
                    if o and (best is None or n - sum(size[i] for i in o[2]) > best[0]):
                        best = (n - sum(size[i] for i in o[2]), take, o)
                if best is None:
                    break
                gain, take, (b, _, give) = best
                bins[a] = [i for i in bins[a] if i not in take] + list(give)
                bins[b] = [i for i in bins[b] if i not in give] + list(take)
                room[a] += gain
                room[b] -= gain
                age[a] += 1
                age[b] += 1
                offer(b)
            if bins[a]:
                offer(a)

    def _choices(self, b: int, pairs: int, giving: bool) -> list[tuple]:
        """Sets of pieces of different sizes that may leave bin b: none (if giving), one or two."""
        by_size = {self.size[i]: i for i in self.bins[b]}
        ones = list(by_size.values())
        out: list[tuple] = [()] if giving else []
        out += [(i,) for i in ones]
        few = self.bins[b][:pairs]
        seen = {}
        for i, j in combinations(few, 2):
            seen.setdefault(self.size[i] + self.size[j], (i, j))
        return out + list(seen.values())


def pack(size: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins (lists of indices) for pieces of these sizes, each from 1 to ``capacity``."""
    b = Bins(size, capacity)
    b.best_fit()
    while True:  # again from the new fills, while a pass empties bins
        was = sum(map(bool, b.bins))
        b.search()
        if sum(map(bool, b.bins)) == was:
            return [x for x in b.bins if x]


def packed(docs: DataFrame, capacity: int = CAPACITY, task_pieces: int = TASK_PIECES, **kw) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    A null text is empty and has its end id alone.  Repeated rows, and null or repeated
    ids, are documents of their own.  Other columns are not read; an empty table gives an
    empty one.  A document longer than ``capacity`` is cut in full pieces, a shorter one
    first; no other is cut.  Reruns agree: the pieces are written before they are dealt, and
    each task packs them in the order of (doc_id, piece, ...), nulls last, whatever way they
    came; rows equal in all of these are the same piece."""
    cutting = cut(pieces(docs, capacity, **kw))
    n = max(1, -(-cutting.where(F.col("length") < capacity).count() // task_pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, used = TaskContext.get().partitionId() << 32, 0
        got = list(batches)
        if not got:
            return
        # in an order of its own: rows arrive as they are fetched
        t = pa.Table.from_batches(got).sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "length", "ids_crc32")])
        size = t.column("length").to_numpy()
        seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        full = np.flatnonzero(size >= capacity)
        seq[full] = base + np.arange(len(full))
        used = len(full)
        rest = np.flatnonzero(size < capacity)
        for lo in range(0, len(rest), 2 * task_pieces):
            part = rest[lo : lo + 2 * task_pieces]
            for bin_ in pack(size[part].tolist(), capacity):
                rows = part[bin_]
                seq[rows] = base + used
                off[rows] = np.concatenate(([0], np.cumsum(size[rows])[:-1]))
                used += 1
        t = t.append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))
        yield from t.combine_chunks().to_batches(max_chunksize=20_000)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cutting.schema) + ", sequence_id long, offset long"
    whole = cutting.where(F.col("length") >= capacity)
    parts = cutting.where(F.col("length") < capacity).repartition(n).mapInArrow(run, schema)
    alone = F.shiftleft(F.lit(1).cast("long"), 62) + F.monotonically_increasing_id()
    return parts.unionByName(whole.select("*", alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
