"""Exact top-k by inner product, as a Voronoi kNN join.

1. Pivots, a bounded sample of the vectors, cut space into cells; each vector goes to the
   cell of its nearest pivot.
2. Summaries by cell (one row each): size, radius and largest norm of its vectors; for its
   queries also the least, over them, of the k-th best score against the pivots.  As
   pivots are candidates themselves, no query of the cell can need a lower score.
3. For query cell i with pivot p and data cell j with pivot c, no score is above
   min(p.c + rq_i |c| + nq_i r_j, nq_i n_j).  Cells whose bound is under the query cell's
   threshold are not sent to it.
4. Query cells are packed in groups of about ``group_queries``.  The data cells that a
   group needs are sent to it once, dealt to tasks by a hash of vec_id, and met by a copy
   of the group's queries, the small side.  A task streams its vectors past its queries
   in blocks and keeps k for each query; a last step joins these short lists.

Pivots are different ids, each once, so the k-th best score against them is one that k
candidates reach.  Products are exact at every magnitude: in doubles while no sum can pass
2^53, in longs up to 2^62, else in Python's whole numbers, with ranks by those.

Nothing is gathered that grows with the data: at the driver there are the pivots and the
cells' summaries, at most ``MAX_CELLS`` of each.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import cut, sized

K, EVERY, MAX_CELLS, GROUP_QUERIES, TASK_ROWS, QUERY_BLOCK = 5, 50, 128, 16_384, 50_000, 4096
_EXACT, _LONG = float(1 << 53), float(1 << 62)
_WIDE_BITS = 2200  # of any sum of products of doubles


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of each component, a whole number as double (exact at any size); null if
    the vector is null or has a component that is null or not finite (256 x included)."""

    def whole(v: Column) -> Column:
        y = v.cast("double") * 256
        return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)

    fine = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double") * 256) < float("inf")))
    return F.when(fine, F.transform(embedding, whole))


def _matrix(col: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list<double> column, zero-padded on the right to the longest (or ``width``)."""
    off = col.offsets.to_numpy()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(off)
    dim = max(width, int(n.max(initial=0)))
    if len(n) and (n == dim).all():
        return flat.reshape(len(n), dim)
    out = np.zeros((len(n), dim))
    at = np.repeat(np.arange(len(n)), n)
    out[at, np.arange(len(flat)) - np.repeat(off[:-1] - off[0], n)] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of rows of whole numbers: longs while every sum surely fits one, else
    Python's whole numbers."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    if not d or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    top = float(np.abs(a).max()) * float(np.abs(b).max()) * d
    if top < _EXACT:
        return (a @ b.T).astype(np.int64)
    if top < _LONG:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.dot(whole(a), whole(b).T)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row: higher score, then smaller id."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


_NONE = np.iinfo(np.int64).min + 1


def _solve(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, best: tuple, k: int) -> tuple:
    """``best`` after a block of candidates (sorted by id); a query's own id is none."""
    s = inner(q, x)
    at = np.searchsorted(xid, qid)
    own = (at < len(xid)) & (xid[np.minimum(at, len(xid) - 1)] == qid)
    s[np.flatnonzero(own), at[own]] = _NONE
    if s.shape[1] > k:
        if np.abs(s[s != _NONE]).max(initial=0) < (1 << 40) and len(xid) < (1 << 20):
            key = np.where(s == _NONE, _NONE, s * len(xid) + (len(xid) - 1 - np.arange(len(xid))))
            top = np.argpartition(key, -k, axis=1)[:, -k:]
        else:
            top = np.lexsort((np.broadcast_to(xid, s.shape), -s), axis=-1)[:, :k]
        s = np.take_along_axis(s, top, 1)
        ids = xid[top]
    else:
        ids = np.broadcast_to(xid, s.shape)
    return _best(np.concatenate((best[0], s), 1), np.concatenate((best[1], ids), 1), k)


def _solve_wide(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, best: list, k: int) -> list:
    """The same for scores of any size: lists of (-score, id)."""
    s = inner(q, x)
    return [heapq.nsmallest(k, old + [(-int(v), int(i)) for v, i in zip(row, xid, strict=True) if i != own]) for old, row, own in zip(best, s, qid, strict=True)]


def _ordered(score: int) -> bytes:
    """A score as bytes of one width that sort as it does."""
    return (score + (1 << _WIDE_BITS - 1)).to_bytes(_WIDE_BITS // 8, "big")


class _Narrow:
    """The k best so far of a block's queries, as longs."""

    def __init__(self, q: np.ndarray, qid: np.ndarray, k: int):
        self.k = k
        self.parts = [(q[a : a + QUERY_BLOCK], qid[a : a + QUERY_BLOCK]) for a in range(0, len(q), QUERY_BLOCK)]
        self.best = [(np.full((len(i), k), _NONE), np.full((len(i), k), np.iinfo(np.int64).max)) for _, i in self.parts]

    def add(self, x: np.ndarray, xid: np.ndarray) -> None:
        self.best = [_solve(q, i, x, xid, b, self.k) for (q, i), b in zip(self.parts, self.best, strict=True)]

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (_, qid), (s, i) in zip(self.parts, self.best, strict=True):
            r, c = np.nonzero(s != _NONE)
            yield pa.RecordBatch.from_arrays([pa.array(qid[r]), pa.array(i[r, c]), pa.array(s[r, c]), pa.nulls(len(r), pa.binary())], names=_SHORT)


class _Wide:
    """The same for scores beyond the longs, which come as the nearest long beside their exact order."""

    def __init__(self, q: np.ndarray, qid: np.ndarray, k: int):
        self.q, self.qid, self.k, self.best = q, qid, k, [[] for _ in qid]

    def add(self, x: np.ndarray, xid: np.ndarray) -> None:
        self.best = _solve_wide(self.q, self.qid, x, xid, self.best, self.k)

    def batches(self) -> Iterator[pa.RecordBatch]:
        low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        rows = [(int(q), i, min(max(-m, low), high), _ordered(-m)) for q, b in zip(self.qid, self.best, strict=True) for m, i in b]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=_SHORT)


_SHORT = ["query_id", "vec_id", "score", "exact"]


def _by_id(rows: DataFrame) -> DataFrame:
    """One row for each vec_id: of different vectors under one id the least.  Only ids are
    shuffled to find the repeated ones; only the rows of these are aggregated, in partial steps."""
    twice = cut(rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"))
    if twice.isEmpty():
        return rows
    few = sized(twice)
    one = rows.join(few, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.join(few, "vec_id", "left_anti").unionByName(one)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, max_cells: int = MAX_CELLS, group_queries: int = GROUP_QUERIES, task_rows: int = TASK_ROWS) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the ``k`` best of ``vectors`` (vec_id, v) for
    each of ``queries`` (vec_id, v), all if there are fewer; ties go to smaller vec_id.

    v: arrays of whole numbers as double; a shorter one counts as padded with zeros, an empty
    one as zeros only.  Rows whose v or vec_id is null take no part, nor does a candidate with
    the query's vec_id.  vec_id is the key: repeated rows count once, and of different vectors
    under one id the least (by component, then length) counts.  A score beyond the longs is
    given as the nearest long, its rank by the exact score.  Other columns are not read; empty
    tables give an empty one."""
    spark = vectors.sparkSession
    known = "v is not null and vec_id is not null"
    data = _by_id(vectors.select("vec_id", "v").where(known))
    asked = _by_id(queries.select("vec_id", "v").where(known))
    n_data, n_asked = data.count(), asked.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n_data or not n_asked:
        return empty
    cells = int(min(max_cells, max(1, round(n_data**0.5 / 4))))
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(cells).toPandas()
    dim = max(map(len, sample["v"]))
    pivot = np.array([list(v) + [0] * (dim - len(v)) for v in sample["v"]], np.float64).reshape(len(sample), dim)
    pivot_id = sample["vec_id"].to_numpy(np.int64)

    def assign(asking: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, 4096):
                    part = b.slice(lo, 4096)
                    ids = part.column(0).to_numpy()
                    x = _matrix(part.column(1), dim)
                    p = np.zeros((len(pivot), x.shape[1]))
                    p[:, :dim] = pivot
                    dot = x @ p.T
                    norm2 = (x * x).sum(1)
                    far2 = norm2[:, None] - 2 * dot + (p * p).sum(1)[None]
                    cell = far2.argmin(1)
                    far = np.sqrt(((x - p[cell]) ** 2).sum(1))
                    least = np.full(len(x), -np.inf)
                    if asking:
                        dot[ids[:, None] == pivot_id[None]] = -np.inf
                        if dot.shape[1] >= k:
                            least = np.partition(dot, -k, axis=1)[:, -k]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cell.astype(np.int32)), pa.array(far), pa.array(np.sqrt(norm2)), pa.array(least)], names=["vec_id", "v", "cell", "far", "norm", "least"])

        return run

    schema = "vec_id long, v array<double>, cell int, far double, norm double, least double"
    data_in, asked_in = data.mapInArrow(assign(False), schema), asked.mapInArrow(assign(True), schema)
    summed = lambda d: d.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("r"), F.max("norm").alias("top"), F.min("least").alias("least")).orderBy("cell").toPandas()
    dc, qc = summed(data_in), summed(asked_in)
    groups, group_of, held = 0, {}, 0
    for c, n in zip(qc["cell"], qc["n"], strict=True):
        if held and held + n > group_queries:
            groups, held = groups + 1, 0
        group_of[int(c)] = groups
        held += n
    pd_, pq = pivot[dc["cell"]], pivot[qc["cell"]]
    bound = pq @ pd_.T + qc["r"].to_numpy()[:, None] * np.linalg.norm(pd_, axis=1)[None] + qc["top"].to_numpy()[:, None] * dc["r"].to_numpy()[None]
    norms = qc["top"].to_numpy()[:, None] * dc["top"].to_numpy()[None]
    bound = np.minimum(bound, norms)
    slack = 1 + 1e-9 * qc["top"].to_numpy()[:, None] * max(float(dc["top"].max()), float(np.linalg.norm(pivot, axis=1).max()))  # of the doubles
    need = ~(bound + slack < qc["least"].to_numpy()[:, None])  # what overflows is needed
    best_of = _Narrow if float(norms.max()) * 1.001 < _LONG else _Wide
    want: dict[int, set] = {}
    rows_of = [0] * (groups + 1)
    for j, c in enumerate(dc["cell"]):
        want[int(c)] = {group_of[int(q)] for i, q in enumerate(qc["cell"]) if need[i, j]}
        for g in want[int(c)]:
            rows_of[g] += int(dc["n"][j])
    # a query cell above the group size is a group of its own, split by hash into blocks of queries
    asked_n = [0] * (groups + 1)
    for c, n in zip(qc["cell"], qc["n"], strict=True):
        asked_n[group_of[int(c)]] += int(n)
    plan = [(g, max(1, -(-rows_of[g] // task_rows)), max(1, -(-asked_n[g] // (2 * group_queries)))) for g in range(groups + 1)]
    sent = spark.createDataFrame([(c, g, plan[g][1], plan[g][2]) for c, gs in want.items() for g in sorted(gs)], "cell int, g int, tasks int, blocks int")
    asks = spark.createDataFrame([(c, g, plan[g][1], plan[g][2]) for c, g in group_of.items()], "cell int, g int, tasks int, blocks int")
    # both tables have at most MAX_CELLS^2 rows
    rows = data_in.select("vec_id", "v", "cell").join(F.broadcast(sent), "cell")
    rows = rows.withColumn("task", F.pmod(F.xxhash64("vec_id"), F.col("tasks")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asks = asked_in.select("vec_id", "v", "cell").join(F.broadcast(asks), "cell")
    asks = asks.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int")).withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    cols = ["g", "block", "task", "kind", "vec_id", "v"]
    stream = asks.withColumn("kind", F.lit(0)).select(cols).unionByName(rows.withColumn("kind", F.lit(1)).select(cols))
    stream = stream.repartition("g", "block", "task").sortWithinPartitions("g", "block", "task", "kind", "vec_id")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, q, qid, best = None, [], [], None
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(i).to_numpy() for i in range(4)], 1)
            cut_at = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cut_at, cut_at[1:], strict=False):
                if at != tuple(key[lo, :3]):
                    if best is not None:
                        yield from best.batches()
                    at, q, qid, best = tuple(key[lo, :3]), [], [], None
                if not key[lo, 3]:
                    q.append(b.column(5).slice(lo, hi - lo))
                    qid.append(b.column(4).slice(lo, hi - lo).to_numpy())
                    continue
                if best is None:
                    if not q:
                        continue
                    best = best_of(_matrix(pa.concat_arrays(q)), np.concatenate(qid), k)
                for a in range(lo, hi, 2048):
                    n = min(2048, hi - a)
                    best.add(_matrix(b.column(5).slice(a, n)), b.column(4).slice(a, n).to_numpy())
        if best is not None:
            yield from best.batches()

    short = stream.mapInArrow(solve, "query_id long, vec_id long, score long, exact binary")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("exact").desc(), F.col("score").desc(), "vec_id"))
    return short.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("v"))
    return top_k(e, e.where(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = f"""WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % {EVERY} = 0 AND d.vec_id <> q.vec_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""
