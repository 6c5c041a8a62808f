"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint holds, for each of 64 bits, what more than half of its
shingles' XXH64 have set.  Fingerprints at Hamming distance ``radius`` or less are
linked.  The tables are the covering family of Pagh (2016): bit i gets a vector
m(i) of radius+1 bits, and the table of a nonzero vector v keeps the bits with odd
<m(i), v>.  The differing bits of a pair within the radius are at most ``radius``
vectors in radius+1 dimensions, so some v is orthogonal to all of them: the pair
agrees on the whole mask of that table.  2^(radius+1)-1 tables find every pair.

Equal fingerprints are merged first, so copies cost nothing.  In a bucket of up to
``small`` distinct fingerprints a task compares them and emits a spanning forest of
the links, not the pairs.  A larger bucket is never gathered: two of its members are
within 4 bits exactly if they share a point within 2 bits of both, and all differing
bits lie outside the mask, so each member names the points within radius/2 of it over
those bits, and members naming one point (which is linked, all of them) form a star.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import cut, join_counted, sized
from .textops import shingles, slices, words, xxh64

SHINGLE, RADIUS, SMALL = 4, 4, 1024


def simhash(col: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprint of each text; zero without words."""
    out = np.zeros(len(col), np.uint64)
    for lo, hi in slices(col):
        w = words(col.slice(lo, hi - lo))
        start, end, doc = shingles(w, shingle)
        if not len(start):
            continue
        h = xxh64(w.buf, start, end)
        rows, at = np.unique(doc, return_index=True)
        ends = np.append(at[1:], len(h))
        # within a row, sums of 0/1 bytes of up to 128 shingles fit a byte; wider sums add those
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        major = votes * 2 > (ends - at)[:, None]
        out[lo + rows] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long, th long) of every row; a null text counts as empty.  th is a hash of
    the text that built-in functions give too, so that rows are found again without Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array(simhash(b.column(1), shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), fp, b.column(2)], names=["doc_id", "fp", "th"])

    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th")).mapInArrow(run, "doc_id long, fp long, th long")


def masks(radius: int = RADIUS) -> list[int]:
    """The covering family's 64-bit masks, one for each nonzero v."""
    n = (1 << (radius + 1)) - 1
    vector = [1 + (i * 7) % n for i in range(64)]
    return [sum(1 << i for i in range(64) if bin(vector[i] & v).count("1") % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(index, index) links that connect what is linked among distinct fingerprints."""
    left = np.arange(len(fps))
    out = []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            near = np.bitwise_count(fps[left] ^ fps[front[0]]) <= radius
            out += [(front[0], int(j)) for j in left[near]]
            front = front[1:] + left[near].tolist()
            left = left[~near]
    return out


def links(fps: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """(a, b): a spanning forest of the links between the nodes of ``fps`` (fp, node),
    which has one row for each distinct fp."""
    tables = masks(radius)
    keyed = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(tables)]))
    keys = fps.select("fp", "node", keyed.alias("k")).select("k.t", "k.key", "fp", "node")
    sizes = keys.groupBy("t", "key").agg(F.count("*").alias("m")).where("m > 1")
    full = keys.join(sizes, ["t", "key"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(0).offsets.to_numpy()
            flat = b.column(0).flatten()
            base = at[0]
            f, node = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            f = f.view(np.uint64)
            two = np.flatnonzero(np.diff(at) == 2)
            i = at[two] - base
            near = np.bitwise_count(f[i] ^ f[i + 1]) <= radius
            a, z = [node[i[near]]], [node[i[near] + 1]]
            for g in np.flatnonzero(np.diff(at) > 2).tolist():
                lo, hi = at[g] - base, at[g + 1] - base
                if pairs := _forest(f[lo:hi], radius):
                    p = np.array(pairs) + lo
                    a.append(node[p[:, 0]])
                    z.append(node[p[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(z))], names=["a", "b"])

    within = (
        full.where(F.col("m") <= small)
        .groupBy("t", "key")
        .agg(F.collect_list(F.struct("fp", "node")).alias("g"))
        .select("g")
        .mapInArrow(compare, "a long, b long")
    )
    free = [[i for i in range(64) if not m >> i & 1] for m in tables]
    balls = [np.array(sorted(sum(1 << i for i in c) for r in range(radius // 2 + 1) for c in combinations(bits, r)), np.uint64) for bits in free]

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t, f, node = (b.column(i).to_numpy() for i in range(3))
            for lo in range(0, len(t), 256):
                z = [f[i].view(np.uint64) ^ balls[t[i]] for i in range(lo, min(lo + 256, len(t)))]
                n = [len(x) for x in z]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(t[lo : lo + 256], n)), pa.array(np.concatenate(z).view(np.int64)), pa.array(np.repeat(node[lo : lo + 256], n))],
                    names=["t", "z", "node"],
                )

    star = (
        full.where(F.col("m") > small)
        .select("t", "fp", "node")
        .mapInArrow(points, "t int, z long, node long")
        .groupBy("t", "z")
        .agg(F.min("node").alias("a"), F.collect_set("node").alias("g"))
        .where(F.size("g") > 1)
        .select("a", F.explode("g").alias("b"))
    )
    if radius % 2:  # two points within radius/2 of one another's midpoint need an even radius
        raise ValueError("radius must be even")
    return within.union(star).where("a != b").distinct()


def _components(docs: DataFrame, shingle: int, radius: int, small: int) -> tuple[DataFrame, DataFrame]:
    """(fingerprints of all rows; fp, n, component_id and root of each distinct fp).  The nodes of
    the graph are fingerprints, so no id, repeated or null, joins texts that are not linked."""
    prints = cut(fingerprints(docs, shingle))
    node = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")))
    comp = cut(components(links(node.select("fp", F.col("fp").alias("node")), radius, small)))
    linked = comp.select(F.col("node").alias("fp"), F.col("component").alias("root")).join(node.select("fp", "node"), "fp")
    least = linked.groupBy("root").agg(F.min("node").alias("least"))
    of = linked.select("fp", "root").join(least, "root")
    named = node.join(of, "fp", "left").select("fp", "n", F.when(F.col("root").isNull(), F.col("node")).otherwise(F.col("least")).alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return prints, cut(named)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """(doc_id, fp long, component_id) for every row of ``docs`` (doc_id, text).

    Null and empty texts have fingerprint zero and link as any other.  Repeated rows
    and ids each get their row, with the component of its own text: the smallest doc_id
    among the rows that its fingerprint reaches, null if none of these has an id.  Rows
    without an id link as any other.  Other columns are not read.  An empty table gives
    an empty one.  Fingerprints that more than a thousandth of the rows share (a thousand
    at most) are broadcast, so no task gathers a large group of copies."""
    prints, named = _components(docs, shingle, radius, small)
    return join_counted(prints, named.select("fp", "n", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """One row of ``docs`` for each component of linked fingerprints: that of the smallest doc_id
    (ids before null), then of the least text hash; rows equal in both are repeats of one text
    under one id, of which the least by all columns stays.  So every text of its own stays,
    whatever other rows share its id, and columns of any name pass through.  Null texts are
    empty and are one component with all other texts of fingerprint zero; an empty table gives
    an empty one.  Ids and hashes are settled first; each text moves once at most, to meet them."""
    prints, named = _components(docs, shingle, radius, small)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    of_text = prints.groupBy("fp", "doc_id", "th").agg(F.count("*").alias("times"))
    of_fp = of_text.groupBy("fp").agg(F.min(F.struct(first.alias("who"), "times")).alias("c"))
    kept = of_fp.join(named.select("fp", "root"), "fp").groupBy("root").agg(F.min("c").alias("c"))
    kept = cut(kept.select(F.col("c.who.doc_id").alias("kept_id"), F.col("c.who.th").alias("kept_th"), F.col("c.times").alias("times")))
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"), F.xxhash64(text).alias("row_th"))
    same = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_th") == F.col("kept_th"))
    single = rows.join(kept.where("times = 1"), same, "left_semi")
    again = kept.where("times > 1")
    if again.isEmpty():
        return single.select("row.*")
    again = sized(again)
    # repeats are folded in partial steps, so a row that stands a million times is no task's burden
    one = rows.join(again, same, "left_semi").groupBy("row_id", "row_th").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return single.select("row.*").unionByName(one.select("row.*"))


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
