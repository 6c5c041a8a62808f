import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voicecorpus.llm import topk as T


def brute(rows, every=50, k=5):
    v = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            w = [math.floor(x * 256) for x in e]
            v[i] = min(v.get(i, w), w)
    out = []
    for q in sorted(x for x in v if x % every == 0):
        s = sorted((-sum(a * b for a, b in zip(v[q], v[i], strict=False)), i) for i in v if i != q)[:k]
        out += [(q, n + 1, i, min(max(-m, -(1 << 63)), (1 << 63) - 1)) for n, (m, i) in enumerate(s)]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, cell string, v int").repartition(3)
    d = df.select("vec_id", T.quantised(F.col("embedding")).alias("v"))
    return sorted(map(tuple, T.top_k(d, d.where("vec_id % 50 = 0"), **kw).collect()))


def clusters(n):
    rng = np.random.default_rng(4)
    mid = rng.normal(0, 1, (6, 12))
    return [(i, (mid[i % 6] + rng.normal(0, 0.05, 12)).tolist()) for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"group_queries": 3, "task_rows": 60, "max_cells": 7}])
def test_matches_brute_force(spark, kw):
    rows = clusters(600)
    rows += [(1000 + i, [0.5] * 12) for i in range(150)]  # ties
    rows += [(2000, None), (2050, [1.0, None] * 6), (2100, [math.inf] * 12), (2150, [math.nan] + [0.0] * 11), (2200, []), (2250, [3.0] * 5), (None, [1.0] * 12), (7, rows[7][1])]
    assert run(spark, rows, **kw) == brute(rows)


def test_few_and_large_and_none(spark):
    assert run(spark, [(0, [1.0]), (50, [2.0]), (3, [-1.0])]) == brute([(0, [1.0]), (50, [2.0]), (3, [-1.0])])
    big = [(i, [1e6 + i, 3.0]) for i in range(0, 120, 10)]
    assert run(spark, big) == brute(big)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == [] and run(spark, [(1, [1.0])]) == []


@pytest.mark.parametrize("copies", [4, 50])
def test_repeats_of_a_pivot_lose_nothing(spark, copies):
    rows = clusters(599)
    ids = spark.createDataFrame([(i,) for i, _ in rows], "vec_id long")
    first = ids.orderBy(F.xxhash64("vec_id"), "vec_id").first().vec_id  # the first pivot by its hash
    again = rows + [rows[first]] * copies
    assert run(spark, again) == brute(rows) and len(brute(rows)) == 60


def test_different_vectors_of_one_id(spark):
    rows = clusters(120) + [(50, [9.0] * 12), (51, [-9.0] * 12), (50, [0.001] * 12)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("size", [1e9, 3e10, 2.0**56, 3.4e38, 1e300])
def test_scores_of_any_size_are_exact(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1, 6) * size).tolist()) for i in range(0, 260, 2)]
    rows += [(301, rows[5][1]), (303, rows[5][1])]
    assert run(spark, rows) == brute(rows)


def test_inner_is_exact_at_each_width():
    for top in (1 << 10, 1 << 28, 1 << 60):
        a = np.array([[top - 1, 3.0], [-top, 7.0]])
        want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in a] for p in a]
        assert T.inner(a, a).tolist() == want
