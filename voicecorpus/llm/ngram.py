"""Language-model scoring with an Elias-Fano n-gram trie (orders 1 to 3).

Counting.  Words' 64-bit hashes are counted first; a word's number is its rank among them.
Then pairs, then triples are counted: each task counts what it reads, and sends every shard
one compressed block of sorted keys and counts, not a row for each n-gram.

Trie.  Level 2 has, for each word, its successors; level 3, for each pair (w1, w2), its own,
each written as its place among the successors of w2 (context-relative), which is a far
smaller number than a word's.  Both levels are Elias-Fano sequences, as are the monotone
pointers to ranges of children and the bases that make level 3 monotone.  Shards are cut
by w1 (level 2) and by ranges of a shard's pairs (level 3), so none holds more than a
bounded number of contexts.  A shard is two files in the shared folder, its sequences and its
probabilities; workers memory-map them, or, where the folder is no mounted file system, hold
a bounded number of bytes of them in memory.  Raw counts lie in a folder of their own that
the driver deletes when the last task that reads them is done, so every task may run twice.

Probabilities.  Interpolated absolute discounting by Kneser and Ney's one discount,
n1 / (n1 + 2 n2), estimated at each order from all counts of counts; the unigram level is the
add-0.1 estimate with one unknown word.  They are quantised to 8 bits by a codebook of each
shard, as are the contexts' back-off weights.  (Modified Kneser-Ney's discounts for counts
of two and more take what stands twice for chance, and gave repeated texts less than single
ones, which is wrong where documents are copied.)

Scoring.  Each task reads its documents once and looks up all n-grams of a slice together;
nothing is shuffled.
"""

from __future__ import annotations

import json
import mmap
import os
import sys
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .eliasfano import EliasFano
from .shared import cut, fold_of, remove, shared_dir
from .textops import slices, words, xxh64

FOLDS, ADD, SHARD_KEYS, CHUNK_BITS, SLICE, HELD_KEYS = 10, 0.1, 2_000_000, 20, 6 << 20, 2_000_000
#: Of a worker: maps of files (which hold a descriptor each before Python 3.13), and bytes where files can't be mapped.
OPEN_FILES, OPEN_BYTES = 16_384 if sys.version_info >= (3, 13) else 512, 256 << 20
_END = np.uint64(0x9E3779B97F4A7C15)  # the end's place among the words' hashes


# ---- blocks and files


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one block: bytes of equal weight side by side, compressed."""
    z = zstandard.ZstdCompressor(level=1)
    out = [np.uint8(len(arrays)).tobytes()]
    for a in arrays:
        top = int(a.max(initial=0))
        a = a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))
        body = z.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())
        out += [np.array([len(a), a.dtype.itemsize, len(body)], np.int64).tobytes(), body]
    return b"".join(out)


def _expand(block: bytes) -> list[np.ndarray]:
    z, out, at = zstandard.ZstdDecompressor(), [], 1
    for _ in range(block[0]):
        n, width, size = np.frombuffer(block, np.int64, 3, at).tolist()
        raw = np.frombuffer(z.decompress(block[at + 24 : at + 24 + size], max_output_size=n * width + 1), np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(width, n).T).view(f"<u{width}").ravel() if n else np.zeros(0, np.uint64))
        at += 24 + size
    return out


def _steps(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=np.uint64(0))


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate((k[:1] == k[:1], k[1:] != k[:-1])))
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _fs(folder: str):
    """(file system, path): None for a mounted one."""
    u = urlparse(folder)
    if u.scheme in ("", "file"):
        return None, u.path
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays as one file, whole or not at all, so a task may run twice."""
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    fs, path = _fs(folder)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    if fs is None:
        os.makedirs(path, exist_ok=True)
    else:
        fs.create_dir(path, recursive=True)
    with open(part, "wb") if fs is None else fs.open_output_stream(part) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for a in arrays.values():
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if len(a) else b"")
            out.write(b"\0" * (-a.nbytes % 64))
    if fs is None:
        os.replace(part, f"{path}/{name}")
    else:
        fs.move(part, f"{path}/{name}")


def _map(path: str) -> mmap.mmap:
    """A file in memory; from Python 3.13 on without holding a descriptor."""
    with open(path, "rb") as f:
        try:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False)
        except TypeError:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


def _load(folder: str, name: str) -> tuple[dict[str, np.ndarray], int]:
    """(arrays, bytes held) of a file."""
    fs, path = _fs(folder)
    raw = _map(f"{path}/{name}") if fs is None else fs.open_input_file(f"{path}/{name}").read()
    n = int.from_bytes(raw[:8], "little")
    arrays = {k: np.frombuffer(raw, kind, size, 8 + n + at) if size else np.zeros(0, kind) for k, (kind, size, at) in json.loads(raw[8 : 8 + n]).items()}
    return arrays, 0 if fs is None else len(raw)


class _Files:
    """Opened files by (folder, name), the least used of them given up; ``opens`` counts."""

    def __init__(self):
        self.held: OrderedDict = OrderedDict()
        self.bytes = self.opens = 0

    def __call__(self, folder: str, name: str) -> tuple[dict[str, np.ndarray], dict[str, EliasFano]]:
        key = (folder, name)
        if key in self.held:
            self.held.move_to_end(key)
        else:
            arrays, size = _load(folder, name)
            self.held[key] = (arrays, {}, size)
            self.bytes += size
            self.opens += 1
            while len(self.held) > 1 and (len(self.held) > OPEN_FILES or self.bytes > OPEN_BYTES):
                self.bytes -= self.held.popitem(last=False)[1][2]
        return self.held[key][:2]

    def clear(self) -> None:
        self.held.clear()
        self.bytes = 0


_files = _Files()


def _fielded(ef: EliasFano, of: str) -> dict[str, np.ndarray]:
    return {f"{of}_{k}": a for k, a in ef.arrays().items()}


def _sequence(folder: str, name: str, of: str) -> EliasFano:
    arrays, made = _files(folder, name)
    if of not in made:
        made[of] = EliasFano(*[arrays[f"{of}_{k}"] for k in EliasFano.FIELDS])
    return made[of]


def _array(folder: str, name: str, key: str) -> np.ndarray:
    return _files(folder, name)[0][key]


def _quantise(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, codebook of 256): single values, or bins of equal width and of equal numbers, by
    their mean; the most frequent values have bins of their own."""
    if not len(logs):
        return np.zeros(0, np.uint8), np.zeros(256)
    value, count = np.unique(logs, return_counts=True)
    edges = value
    if len(value) > 256:
        often = value[np.argsort(-count, kind="stable")[:40]]  # each its own bin
        even = np.linspace(value[0], value[-1], 100)
        edges = np.unique(np.concatenate((often, np.nextafter(often, np.inf), even, np.quantile(logs, np.linspace(0, 1, 76)))))
        edges = edges[edges <= value[-1]]
    code = np.searchsorted(edges, logs, "right") - 1
    total, size = np.bincount(code, logs, 256), np.bincount(code, minlength=256)
    return code.astype(np.uint8), total / np.maximum(size, 1)


# ---- the trie as workers see it


class Trie:
    """``meta``: folder, N, V, shards of words, pairs and (for each of these) of triples."""

    def __init__(self, meta: dict):
        self.m = meta
        self.folder = meta["folder"]

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + ADD) / (self.m["N"] + ADD * (self.m["V"] + 1)))

    def numbers(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count) of hashes; -1 and 0 for unknown ones."""
        n, c = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        part = self._word_shard(h)
        for s in np.unique(part).tolist():
            at = np.flatnonzero(part == s)
            known, counts = _array(self.folder, f"words{s}", "hash"), _array(self.folder, f"words{s}", "count")
            if not len(known):
                continue
            i = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
            ok = known[i] == h[at]
            n[at[ok]] = i[ok] + self.m["word_at"][s]
            c[at[ok]] = counts[i[ok]]
        return n, c

    def counts(self, n: np.ndarray) -> np.ndarray:
        """How often each numbered word was counted."""
        out = np.zeros(len(n), np.int64)
        at = np.asarray(self.m["word_at"])
        for s, i in _by(np.searchsorted(at, n, "right") - 1):
            out[i] = _array(self.folder, f"words{s}", "count")[n[i] - at[s]]
        return out

    def _word_shard(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - 16)).astype(np.int64) * self.m["word_shards"] >> 16

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in a's shard, place among a's successors) of pairs; -1 if unseen.  Pairs are
        sorted and looked up once each, a word's range of successors once for all of its."""
        place, rank = np.full(len(a), -1, np.int64), np.full(len(a), -1, np.int64)
        ok = np.flatnonzero((a >= 0) & (b >= 0))
        if not len(ok):
            return place, rank
        shards, words_ = self.m["pair_shards"], self.m["words"]
        width = np.uint64(-(-words_ // shards) * words_)
        key = (a[ok] % shards).astype(np.uint64) * width + (a[ok] // shards).astype(np.uint64) * np.uint64(words_) + b[ok].astype(np.uint64)
        key, back = _distinct(key)
        shard = (key // width).astype(np.int64)
        got, got_rank = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            k = key[cuts[s] : cuts[s + 1]] - np.uint64(s) * width
            local = (k // np.uint64(words_)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], local[1:] != local[:-1])))
            times = np.diff(np.append(first, len(local)))
            ptr, seq = (_sequence(self.folder, f"pairs{s}", of) for of in ("ptr", "key"))
            lo, hi = (np.repeat(ptr.get(local[first] + d).astype(np.int64), times) for d in (0, 1))
            i = seq.find(lo, hi, k)
            got[cuts[s] : cuts[s + 1]] = i
            got_rank[cuts[s] : cuts[s + 1]] = np.where(i >= 0, i - lo, -1)
        place[ok], rank[ok] = got[back], got_rank[back]
        return place, rank

    def successors(self, a: np.ndarray) -> np.ndarray:
        """How many successors each word has."""
        out = np.zeros(len(a), np.int64)
        for s, at in _by(a % self.m["pair_shards"]):
            local = a[at] // self.m["pair_shards"]
            ptr = _sequence(self.folder, f"pairs{s}", "ptr")
            out[at] = (ptr.get(local + 1) - ptr.get(local)).astype(np.int64)
        return out

    def first(self, a: np.ndarray) -> np.ndarray:
        """The place of each word's first successor in its shard."""
        out = np.zeros(len(a), np.int64)
        for s, at in _by(a % self.m["pair_shards"]):
            out[at] = _sequence(self.folder, f"pairs{s}", "ptr").get(a[at] // self.m["pair_shards"]).astype(np.int64)
        return out

    def coded(self, kind: str, shard: np.ndarray, i: np.ndarray, what: str) -> np.ndarray:
        """Values of a quantised array of shards of ``kind``."""
        out = np.zeros(len(i))
        for s, at in _by(shard):
            out[at] = _array(self.folder, f"{kind}{s}.p", f"{what}_book")[_array(self.folder, f"{kind}{s}.p", what)[i[at]]]
        return out

    def logs(self, w: np.ndarray, c: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """log10 probability of each token given the two before it.  ``w``, ``c``: numbers and
        counts; ``first``, ``last``: the tokens that begin and end a document."""
        start = self.m["words"] - 1
        before = np.concatenate(([start], w[:-1]))
        before[first] = start
        place, rank = self.pairs(before, w)
        shards, chunk = self.m["pair_shards"], np.int64(1) << CHUNK_BITS
        # the pair before each token is the context of its triple
        ctx, ctx_word = np.concatenate(([-1], place[:-1])), np.concatenate(([-1], before[:-1]))
        ctx[first] = -1
        out = np.zeros(len(w))
        third = np.full(len(w), -1, np.int64)
        h = np.flatnonzero(ctx >= 0)
        # sorted by context, so that look-ups go through the files in order
        node = ((ctx_word[h] % shards) << 40) | ctx[h]
        h = h[np.argsort(node)]
        for code, at in _runs(((ctx_word[h] % shards) << 32) | (ctx[h] // chunk)):
            rows, name = h[at], (code >> 32, code & 0xFFFFFFFF)
            if name not in self.m["triples"]:
                continue
            key = f"triples{name[0]}_{name[1]}"
            local = ctx[rows] % chunk
            out[rows] = _array(self.folder, f"{key}.p", "back_book")[_array(self.folder, f"{key}.p", "back")[local]]
            seen = np.flatnonzero(rank[rows] >= 0)
            if not len(seen):
                continue
            r, local = rows[seen], local[seen]
            ptr, base, seq = (_sequence(self.folder, key, k) for k in ("ptr", "base", "key"))
            first = np.flatnonzero(np.concatenate(([True], local[1:] != local[:-1])))
            times, one = np.diff(np.append(first, len(local))), local[first]
            lo, hi, start_at = (np.repeat(x, times) for x in (ptr.get(one).astype(np.int64), ptr.get(one + 1).astype(np.int64), base.get(one)))
            i = seq.find(lo, hi, start_at + rank[r].astype(np.uint64))
            hit = np.flatnonzero(i >= 0)
            third[r[hit]] = i[hit]
            out[r[hit]] = _array(self.folder, f"{key}.p", "prob_book")[_array(self.folder, f"{key}.p", "prob")[i[hit]]]
        two = np.flatnonzero((third < 0) & (place >= 0))
        out[two] += self.coded("pairs", before[two] % shards, place[two], "prob")
        one = np.flatnonzero((third < 0) & (place < 0))
        out[one] += self.unigram(c[one])
        known = one[before[one] >= 0]
        out[known] += self.coded("pairs", before[known] % shards, before[known] // shards, "back")
        return out


def _runs(key: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, range) of each run of a value in a key that has each value in one run."""
    if len(key):
        at = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for lo, hi in zip(at, at[1:], strict=False):
            yield int(key[lo]), slice(lo, hi)


def _by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, places) for each value of ``key``."""
    small = len(key) and key.min() >= 0 and key.max() < 1 << 16
    order = np.argsort(key.astype(np.uint16) if small else key, kind="stable")
    for value, at in _runs(key[order]):
        yield value, order[at]


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, where each is among them)."""
    order = np.argsort(key)
    k = key[order]
    new = np.concatenate(([True], k[1:] != k[:-1]))
    back = np.empty(len(key), np.int64)
    back[order] = np.cumsum(new) - 1
    return k[new], back


_held: list[Trie] = []


def _trie(meta: dict) -> Trie:
    """This worker's view of the trie, made anew when there is more of it, or another one."""
    if not _held or _held[0].m != meta:
        if _held and _held[0].folder != meta["folder"]:
            _files.clear()
        _held[:] = [Trie(dict(meta))]
    return _held[0]


# ---- tokens


def _tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each token, places of documents' first tokens, of their ends)."""
    w = words(col)
    h = xxh64(w.buf, w.start, w.end)
    h[h == _END] += np.uint64(1)
    end = w.first[1:] + np.arange(w.rows)
    out = np.empty(len(h) + w.rows, np.uint64)
    out[np.arange(len(h)) + w.doc] = h
    out[end] = _END
    return out, np.concatenate(([0], end[:-1] + 1)), end


def _numbered(trie: Trie, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, back = _distinct(h)
    n, c = trie.numbers(u)
    return n[back], c[back]


def _count(docs: DataFrame, keys_of: Callable, shard_of: Callable) -> DataFrame:
    """(shard, block): sorted keys, as steps, and counts.  A task holds a bounded number of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            shard, blocks = [], []
            parts: dict[int, list] = {}
            for (group, k), c in zip(keys, counts, strict=True):
                parts.setdefault(group, []).append((k, c))
            for group, kc in parts.items():
                k, c = _counted([x for x, _ in kc], [x for _, x in kc])
                for s, at in _by(shard_of(group, k)):
                    shard.append(s)
                    blocks.append(_squeeze(_steps(k[at]), c[at]))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(blocks, pa.binary())], names=["shard", "block"])

        for b in batches:
            for lo, hi in slices(b.column(0), SLICE):
                for group, k in keys_of(b.column(0).slice(lo, hi - lo)):
                    k, c = np.unique(k, return_counts=True)
                    keys.append((group, k))
                    counts.append(c)
                    held += len(k)
                if held > HELD_KEYS:
                    yield from flush()
                    keys, counts, held = [], [], 0
        if keys:
            yield from flush()

    return docs.select("text").mapInArrow(run, "shard long, block binary")


def _merge(counted: DataFrame, shards: int, build: Callable) -> list:
    """Run ``build(shard, keys, counts)`` for each shard, from 0 on, where its blocks meet; the rows
    (shard, list of numbers) that it returns come to the driver, one for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, held = None, [], [], 0

        def done() -> Iterator[pa.RecordBatch]:
            if now is not None:
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([build(now, *_counted(keys, counts))], pa.list_(pa.int64()))], names=["shard", "out"])

        for b in batches:
            for s, block in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if s != now:
                    yield from done()
                    now, keys, counts, held = s, [], [], 0
                steps, c = _expand(block.as_py())
                keys.append(np.cumsum(steps.astype(np.uint64), dtype=np.uint64))
                counts.append(c.astype(np.int64))
                held += len(c)
                if held > HELD_KEYS and len(keys) > 1:
                    k, c = _counted(keys, counts)
                    keys, counts, held = [k], [c], 0
        yield from done()

    dealt = counted.repartitionById(max(1, shards), F.col("shard").cast("int")).sortWithinPartitions("shard")  # a task each
    return dealt.mapInArrow(run, "shard long, out array<long>").collect()


def _per_shard(spark: SparkSession, names: list, work: Callable) -> list:
    """``work(name)`` for each of these shards, in tasks of their own; returns lists of long."""
    if not names:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([work(n)], pa.list_(pa.int64()))], names=["shard", "out"])

    df = spark.createDataFrame([(n,) for n in names], "shard long").repartition(len(names))
    return df.mapInArrow(run, "shard long, out array<long>").collect()


def _small_counts(c: np.ndarray) -> dict[str, np.ndarray]:
    big = np.flatnonzero(c >= 255)
    return {"small": np.minimum(c, 255).astype(np.uint8), "big_at": big, "big": c[big]}


def _counts_of(folder: str, name: str) -> np.ndarray:
    raw = _load(f"{folder}/{RAW}", name)[0]
    c = raw["small"].astype(np.int64)
    c[raw["big_at"]] = raw["big"]
    return c


RAW = "counts"


def _discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from the counts of counts 1 to 4."""
    n1, n2 = float(n[0]), float(n[1])
    d = min(max(n1 / (n1 + 2 * n2), 0.05), 0.98) if n1 else 0.5
    return np.array([0.0, d, d, d])


def _smoothed(c: np.ndarray, group: np.ndarray, groups: int, d: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 probability of each n-gram, log10 back-off weight of each context)."""
    cut_ = d[np.minimum(c, 3)]
    total = np.bincount(group, c, groups)
    back = np.bincount(group, cut_, groups) / np.maximum(total, 1)
    back[total == 0] = 1.0
    p = (c - cut_) / total[group] + back[group] * lower
    return np.log10(np.maximum(p, 1e-300)), np.log10(back)


def train(docs: DataFrame, folder: str | None = None) -> dict:
    """Build a trie from all of ``docs`` (text); returns what ``Trie`` needs.  Texts that are
    null count as empty: an end each.  Repeated rows count each; other columns are not read.
    Without rows there are no shards, and N and V are 0.  ``drop`` deletes its files."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark).rstrip('/')}/ngram-{uuid.uuid4().hex}"
    docs = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    many = min(1 << 16, max(64, docs.rdd.getNumPartitions()))  # shards of words follow the input
    meta: dict = {"folder": folder, "N": 0, "V": 0, "words": 1, "word_shards": many, "word_at": [0] * many, "pair_shards": 1, "triples": frozenset()}

    # words
    word_shard = lambda _, k: (k >> np.uint64(48)).astype(np.int64) * many >> 16
    counted = _count(docs, lambda col: [(0, _tokens(col)[0])], word_shard)

    def save_words(s: int, k: np.ndarray, c: np.ndarray) -> list[int]:
        _save(folder, f"words{s}", {"hash": k, "count": c})
        return [len(k), int(c.sum())]

    got = {r.shard: r.out for r in _merge(counted, many, save_words)}
    for s in range(many):
        if s not in got:
            save_words(s, np.zeros(0, np.uint64), np.zeros(0, np.int64))
            got[s] = [0, 0]
    sizes = [got[s][0] for s in range(many)]
    meta |= {"N": sum(got[s][1] for s in range(many)), "V": sum(sizes), "words": sum(sizes) + 1, "word_at": [0, *np.cumsum(sizes[:-1]).tolist()]}
    if not meta["N"]:
        return meta
    words_ = meta["words"]
    shards = meta["pair_shards"] = max(1, -(-int(0.6 * meta["N"]) // SHARD_KEYS))

    # pairs
    def pair_keys(col: pa.Array) -> list:
        h, first, _ = _tokens(col)
        w, _ = _numbered(_trie(meta), h)
        before = np.concatenate(([words_ - 1], w[:-1]))
        before[first] = words_ - 1
        return [(0, (before % shards).astype(np.uint64) * np.uint64(-(-words_ // shards) * words_) + (before // shards).astype(np.uint64) * np.uint64(words_) + w.astype(np.uint64))]

    width = np.uint64(-(-words_ // shards) * words_)

    def save_pairs(s: int, k: np.ndarray, c: np.ndarray) -> list[int]:
        k = k - np.uint64(s) * width
        local = -(-words_ // shards)
        ptr = np.searchsorted(k, np.arange(local + 1, dtype=np.uint64) * np.uint64(words_))
        _save(folder, f"pairs{s}", _fielded(EliasFano.build(k), "key") | _fielded(EliasFano.build(ptr), "ptr"))
        _save(f"{folder}/{RAW}", f"pairs{s}", _small_counts(c))
        return [len(k), *np.bincount(np.minimum(c, 5), minlength=6)[1:5].tolist()]

    stats = {r.shard: r.out for r in _merge(_count(docs, pair_keys, lambda _, k: (k // width).astype(np.int64)), shards, save_pairs)}
    for s in range(shards):
        if s not in stats:
            stats[s] = save_pairs(s, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    d2 = _discounts(np.sum([stats[s][1:] for s in range(shards)], 0))

    def finish_pairs(s: int) -> list[int]:
        trie = _trie(meta)
        k, c = _sequence(folder, f"pairs{s}", "key").all(), _counts_of(folder, f"pairs{s}")
        before, after = (k // np.uint64(words_)).astype(np.int64), (k % np.uint64(words_)).astype(np.int64)
        p, back = _smoothed(c, before, -(-words_ // shards), d2, 10 ** trie.unigram(trie.counts(after)))
        out = {}
        for what, logs in (("prob", p), ("back", back)):
            out[what], out[f"{what}_book"] = _quantise(logs)
        _save(folder, f"pairs{s}.p", out)
        return []

    _per_shard(spark, list(range(shards)), finish_pairs)
    remove(spark, f"{folder}/{RAW}")

    # triples: place of the pair in its shard, then place among the successors of its second word
    chunk = 1 << CHUNK_BITS
    chunks_before = np.concatenate(([0], np.cumsum([-(-stats[s][0] // chunk) for s in range(shards)])))
    named = lambda code: (s := int(np.searchsorted(chunks_before, code, "right")) - 1, int(code - chunks_before[s]))
    rank_bits = np.uint64(max(1, words_.bit_length()))

    def triple_keys(col: pa.Array) -> list:
        h, first, _ = _tokens(col)
        trie = _trie(meta)
        w, _ = _numbered(trie, h)
        before = np.concatenate(([words_ - 1], w[:-1]))
        before[first] = words_ - 1
        place, rank = trie.pairs(before, w)
        ctx, ctx_word = np.concatenate(([-1], place[:-1])), np.concatenate(([-1], before[:-1]))
        ctx[first] = -1
        out = []
        at = np.flatnonzero(ctx >= 0)
        for s, i in _by(ctx_word[at] % shards):
            r = at[i]
            out.append((s, (ctx[r].astype(np.uint64) << rank_bits) | rank[r].astype(np.uint64)))
        return out

    def save_triples(code: int, k: np.ndarray, c: np.ndarray) -> list[int]:
        s, part = named(code)
        trie, lo = _trie(meta), part * chunk
        pairs = _sequence(folder, f"pairs{s}", "key")
        n = min(chunk, pairs.n - lo)
        second = (pairs.get(np.arange(lo, lo + n)) % np.uint64(words_)).astype(np.int64)
        base = np.concatenate(([0], np.cumsum(trie.successors(second))))
        local = (k >> rank_bits).astype(np.int64) - lo
        rank = (k & ((np.uint64(1) << rank_bits) - np.uint64(1))).astype(np.int64)
        ptr = np.searchsorted(local, np.arange(n + 1))
        name = f"triples{s}_{part}"
        _save(folder, name, _fielded(EliasFano.build(base[local] + rank), "key") | _fielded(EliasFano.build(ptr), "ptr") | _fielded(EliasFano.build(base), "base"))
        _save(f"{folder}/{RAW}", name, _small_counts(c))
        return [len(k), *np.bincount(np.minimum(c, 5), minlength=6)[1:5].tolist()]

    chunk_of = lambda s, k: chunks_before[s] + ((k >> rank_bits).astype(np.int64) >> CHUNK_BITS)
    n_chunks = int(chunks_before[-1])
    stats3 = {r.shard: r.out for r in _merge(_count(docs, triple_keys, chunk_of), n_chunks, save_triples)}
    d3 = _discounts(np.sum([x[1:] for x in stats3.values()], 0)) if stats3 else np.zeros(4)

    def finish_triples(code: int) -> list[int]:
        s, part = named(code)
        trie, lo, name = _trie(meta), part * chunk, f"triples{s}_{part}"
        pairs = _sequence(folder, f"pairs{s}", "key")
        ptr = _sequence(folder, name, "ptr").all().astype(np.int64)
        n = len(ptr) - 1
        local = np.repeat(np.arange(n), np.diff(ptr))
        rank = (_sequence(folder, name, "key").all() - _sequence(folder, name, "base").all()[local]).astype(np.int64)
        second = (pairs.get(np.arange(lo, lo + n)) % np.uint64(words_)).astype(np.int64)
        lower = 10 ** trie.coded("pairs", second[local] % shards, trie.first(second)[local] + rank, "prob")
        p, back = _smoothed(_counts_of(folder, name), local, n, d3, lower)
        out = {}
        for what, logs in (("prob", p), ("back", back)):
            out[what], out[f"{what}_book"] = _quantise(logs)
        _save(folder, f"{name}.p", out)
        return []

    _per_shard(spark, sorted(stats3), finish_triples)
    remove(spark, f"{folder}/{RAW}")
    return meta | {"triples": frozenset(map(named, stats3))}


RESULT = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, meta: dict) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A null text is empty: its end is its only token.  Repeated rows and null ids each get
    their row; other columns are not read; an empty table gives an empty one.  With nothing
    learnt every token has probability 1 (one unknown word).  Long texts count whole."""
    shared = docs.sparkSession.sparkContext.broadcast(meta)  # names of files and a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(shared.value)
        for b in batches:
            for lo, hi in slices(b.column(1), SLICE):
                h, first, last = _tokens(b.column(1).slice(lo, hi - lo))
                w, c = _numbered(trie, h) if trie.m["N"] else (np.full(len(h), -1), np.zeros(len(h), np.int64))
                base = trie.unigram(c)
                logs = trie.logs(w, c, first, last) if trie.m["N"] else base
                of_doc = lambda x: np.add.reduceat(x, first)  # noqa: E731, B023
                n = len(first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(last - first + 1), pa.array(of_doc((c > 0).astype(np.int64))), pa.array(np.full(n, trie.m["N"], np.int64)), pa.array(of_doc(base)), pa.array(of_doc(logs))],
                    names=[x.split()[0] for x in RESULT.split(", ")],
                )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.mapInArrow(run, RESULT)


def drop(spark: SparkSession, meta: dict) -> None:
    """Delete a trie's files."""
    remove(spark, meta["folder"])


def op7_lm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = fold_of(F.col("doc_id"), FOLDS) == 0
    meta = train(docs.where(~held))
    scored = cut(score(docs, meta).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"))
    drop(spark, meta)  # the scores are written
    return scored
