"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the ``k`` smallest distinct 48-bit hashes of a text's word shingles.
Sketches merge across parts of a document or corpus (the k smallest of their union), and
estimate resemblance, containment and the number of distinct shingles.  Up to k distinct
shingles every estimate is exact but for hash collisions.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import cut, sized
from .textops import shingles, slices, words, xxh64

SHINGLE, K = 5, 128
_BITS = 48


def sketches(col: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """A sorted uint64 array of up to ``k`` hashes for each text; empty without words."""
    out: list[np.ndarray] = []
    for lo, hi in slices(col):
        for a in range(lo, hi, 1 << 14):  # 16 bits of row and 48 of hash sort as one number
            n = min(hi, a + (1 << 14)) - a
            w = words(col.slice(a, n))
            start, end, doc = shingles(w, shingle)
            h = xxh64(w.buf, start, end) >> np.uint64(64 - _BITS)
            key = np.unique(doc.astype(np.uint64) << np.uint64(_BITS) | h)
            at = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(_BITS))
            key &= np.uint64((1 << _BITS) - 1)
            out += [key[at[i] : min(at[i] + k, at[i + 1])].copy() for i in range(n)]
    return out


def merge(*parts: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of what the parts sketch."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; 1 for two empty sketches, 0 for one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    same = both[:-1][both[1:] == both[:-1]]
    union = both[np.concatenate(([True], both[1:] != both[:-1]))][:k]
    return float(np.searchsorted(same, union[-1], "right")) / len(union)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << _BITS) / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 where a is empty."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k=k), k) / distinct(a, k))


def encode(a: np.ndarray) -> str:
    """A sketch as text: base64 of 6 bytes a hash, big-endian, ascending."""
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.concatenate((np.zeros((len(raw), 2), np.uint8), raw), axis=1).copy().view(">u8").ravel().astype(np.uint64)


def fingerprint(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text counts as empty (fingerprint '')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([encode(s) for s in sketches(b.column(1), k, shingle)], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def merge_by(sketched: DataFrame, key: str, k: int = K, salts: int = 64) -> DataFrame:
    """(key, fingerprint): the merged sketch of each key of ``sketched`` (key, fingerprint).

    Batches are merged before the shuffle and each key over ``salts`` tasks, so a key with
    most of the rows sends a sketch for each batch and no task gets more than its share of
    those.  Null fingerprints count as empty; a null key is a key."""
    schema = sketched.select(key, "fingerprint").schema

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(v, encode(merge(*[decode(x or "") for x in g], k=k))) for v, g in f["fingerprint"].groupby(f[key], dropna=False)]
            yield pd.DataFrame(rows, columns=[key, "fingerprint"])

    out = sketched.select(key, "fingerprint")
    for grain in (F.spark_partition_id() % salts, F.lit(0)):
        out = out.mapInPandas(local, schema).repartition(F.col(key), grain).sortWithinPartitions(key)
    whole = out.mapInPandas(local, schema)

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.head(1).assign(fingerprint=encode(merge(*[decode(x) for x in pdf["fingerprint"]], k=k)))

    return whole.groupBy(key).applyInPandas(final, schema)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(k: int, shingle: int):
    """Over rows (part, ghost, doc_id, text) sorted within parts: a result for each row
    that is no ghost, with the row after it as the next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last row so far, and its sketch
        held_sketch: list[np.ndarray] = []
        for b in batches:
            if not b.num_rows:
                continue
            for lo, hi in slices(b.column(3)):
                part = pa.Table.from_batches([b.slice(lo, hi - lo)])
                own = held_sketch + sketches(part.column(3).combine_chunks(), k, shingle)
                t = pa.concat_tables([held, part]) if held is not None else part
                t = t.combine_chunks()
                texts = [x or "" for x in t.column(3).to_pylist()]
                keep = [i for i, g in enumerate(t.column(1).to_pylist()[:-1]) if not g]
                ids = t.column(2).to_pylist()
                edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in keep]
                new = sketches(pa.array(edited, pa.string()), k, shingle)
                if keep:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[i] for i in keep], pa.int64()),
                            pa.array([len(texts[i]) for i in keep], pa.int64()),
                            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                            pa.array([encode(own[i]) for i in keep], pa.string()),
                            pa.array([encode(s) for s in new], pa.string()),
                            pa.array([resemblance(own[i], s, k) for i, s in zip(keep, new, strict=True)], pa.float64()),
                            pa.array([resemblance(own[i], own[i + 1], k) for i in keep], pa.float64()),
                        ],
                        names=[c.split()[0] for c in RESULT.split(", ")],
                    )
                held, held_sketch = t.slice(t.num_rows - 1), own[-1:]

    return run


PART_BYTES, MANY_PARTS, LARGE_PART = 16 << 20, 1024, 128 << 20


def _cuts(bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, how many cuts stand there) of the parts' lower bounds, in order.  ``bounds``: quantiles
    of the ids; an id so frequent that several fall on it is cut at as many even shares of its
    text hashes."""
    at: Counter = Counter(bounds)
    for v, m in list(at.items()):
        if m > 1 and v + 1 not in at and v < np.iinfo(np.int64).max:
            at[v + 1] = 1  # where the frequent id ends
    ids = np.array(sorted(at), np.int64)
    return ids, np.array([at[i] for i in ids.tolist()], np.int64)


def compare_neighbours(docs: DataFrame, k: int = K, shingle: int = SHINGLE, parts: int | None = None) -> DataFrame:
    """Sketch each text and its edited text, and compare each with the next document.

    The edited text of n code points has its last n//2 replaced by the first as many (or
    all) of the next document by (doc_id, a hash of the text, text), nulls first; the last
    one's next is the first, so a single document is its own.  Null texts are empty.
    Repeated rows and ids follow one another; other columns are not read; an empty table
    gives an empty one.

    Documents are dealt to ranges of (doc_id, hash), as many as their counted bytes ask for,
    with quantiles of the ids as bounds, and each range is a task.  An id, or none, that many
    rows have is cut by the hash.  Each range also gets a copy of the document after it, so no
    window spans the table and a task reads its range once, holding a slice of a batch.  Of
    the ranges the driver holds the bounds alone."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.shiftrightunsigned(F.xxhash64(text), 11).alias("th"), text.alias("text"))
    rows, missing, size = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull()), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if not rows:
        return spark.createDataFrame([], RESULT)
    n = parts or max(1, -(-size // min(max(PART_BYTES, size // MANY_PARTS), LARGE_PART)))
    bounds = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], min(100 * n, 1_000_000))).first()[0] if n > 1 else None
    for_null = max(1, round(n * missing / rows)) if missing else 0
    ids, times = _cuts(bounds or [])
    upto = np.concatenate(([0], np.cumsum(times)))
    total = for_null + int(upto[-1]) + 1

    @F.pandas_udf("int")
    def part_of(doc_id: pd.Series, th: pd.Series) -> pd.Series:
        u = th.to_numpy(np.int64) / float(1 << 53)
        one = doc_id.fillna(0).to_numpy(np.int64)
        i = np.searchsorted(ids, one, "left")
        on = (i < len(ids)) & (ids[np.minimum(i, len(ids) - 1)] == one) if len(ids) else np.zeros(len(one), bool)
        m = times[np.minimum(i, len(ids) - 1)] if len(ids) else np.ones(len(one), np.int64)
        at = upto[i] + np.where(on, np.minimum((u * m).astype(np.int64), m - 1) + 1, 0) + for_null
        return pd.Series(np.where(doc_id.isna(), np.minimum((u * for_null).astype(np.int64), max(0, for_null - 1)), at).astype(np.int32))

    placed = docs.withColumn("part", part_of("doc_id", "th"))
    key = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "th")
    firsts = cut(placed.groupBy("part").agg(F.min(key).alias("f")).select("part", "f.doc_id", "f.th"))
    order = W.orderBy("part")  # one row for each part
    firsts = firsts.withColumn("back", F.coalesce(F.lag("part").over(order), F.max("part").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    f = sized(firsts.select(F.col("part").alias("p"), F.col("doc_id").alias("i"), F.col("th").alias("t"), "back"))
    heads = placed.join(f, (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")))
    ghosts = heads.groupBy("back", "doc_id").agg(F.min("text").alias("text")).select(F.col("back").alias("part"), F.lit(1).alias("ghost"), "doc_id", F.lit(0).cast("long").alias("th"), "text")
    both = placed.select("part", F.lit(0).alias("ghost"), "doc_id", "th", "text").unionByName(ghosts)
    each = both.repartitionById(total, "part").sortWithinPartitions("part", "ghost", "doc_id", "th", "text")
    return each.select("part", "ghost", "doc_id", "text").mapInArrow(_compare(k, shingle), RESULT)


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"))
