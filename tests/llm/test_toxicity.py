from itertools import combinations

import numpy as np
import pytest

from voicecorpus.llm import toxicity as T


def brute_kernel(a, b):
    def feats(u):
        s, out = f"\x02{u}\x03", {}
        for c in combinations(range(len(s)), T.ORDER):
            key = "".join(s[i] for i in c)
            out[key] = out.get(key, 0) + T.DECAY ** (c[-1] - c[0] + 1)
        return out

    x, y = feats(a), feats(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


def test_kernel_is_the_subsequence_kernel():
    marks = ["idiot", "scum", "abab"]
    f = T.Features(marks)
    units = ["idiot", "idxiot", "id", "zzz", "scums", "aabb", "ééé", "i"]
    got = f.project(units, f.table(marks))
    want = [[brute_kernel(u, m) for m in marks] for u in units]
    assert np.allclose(got, want, atol=1e-5)


def test_units():
    assert T.units_of("You i d i o t, i.d.i.o.t! 12 me") >= {"you", "idiot", "me"}
    assert T.units_of(None) == set() and T.units_of("12 ...") == set()
    assert all(len(u) <= T.WINDOW for u in T.units_of("x" * 100_000 + " a"))


def corpus(n=300):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("aeioulmnrst"), int(rng.integers(2, 9)))) for _ in range(600)]
    rows = []
    for i in range(n):
        w = [words[k] for k in rng.integers(0, 600, 60)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w.insert(int(rng.integers(0, len(w))), ["gobdux", "wizzok", "krumpf"][int(rng.integers(0, 3))])
        t = " ".join(w)
        rows.append((i, t[:150] + ". " + t[150:], int(bad)))
    return rows


def test_learns_and_tolerates_insertions():
    rows = corpus()
    m = T.learn([t for _, t, _ in rows[:200]], [y for _, _, y in rows[:200]], landmarks=24)
    s = m.score([t for _, t, _ in rows[200:]])
    assert ((s >= 0.5) == np.array([y for _, _, y in rows[200:]], bool)).mean() > 0.97
    got = m.score(["", None, "say g o b d u x now", "gob-dux", "gobddux", rows[1][1]])
    assert got[0] == got[1] < 0.5 and (got[2:5] >= 0.5).all() and got[5] < 0.5


def test_tables(spark):
    rows = corpus(200) + [(1000, None, 0), (1001, "", 0), (None, "krumpf", 1)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t, _ in rows], "doc_id long, text string, score string, predicted int").repartition(3)
    labels = spark.createDataFrame([(d, y, y) for d, _, y in rows] + [(5, None, 0), (5, 1, 1)], "doc_id long, toxic int, quality int")
    m = T.train(docs, labels)
    got = T.predict(docs, m).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    kept = T.clean(docs, m)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    m = T.train(docs, labels)
    assert T.predict(docs, m).collect() == [(1, 0.0, 0)]
    assert T.predict(docs.limit(0), m).collect() == []


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_held_out_accuracy(spark, sf):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = docs.join(labels, "doc_id").where(T.fold_of(F.col("doc_id"), T.FOLDS) == 0).select("doc_id", "text", "toxic")
    m = T.train(docs, labels)
    got = T.predict(held, m).join(labels, "doc_id").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit >= 0.9 * sum(r.toxic for r in got) and hit >= 0.9 * sum(r.predicted for r in got)


def test_long_and_repeated_texts(spark):
    rows = corpus()
    m = T.learn([t for _, t, _ in rows], [y for _, _, y in rows], landmarks=24)
    plain = next(t for _, t, y in rows if not y)
    long = " ".join([plain] * 4000)  # over a million letters
    docs = spark.createDataFrame([(1, long), (2, long + " wizzok"), (2, long + " wizzok"), (3, plain), (4, "y" * 300_000)], "doc_id long, text string")
    got = sorted((r.doc_id, r.score) for r in T.predict(docs, m).collect())
    assert got[0][1] == got[3][1] < 0.5 <= got[1][1] and got[1] == got[2] and 0 <= got[4][1] <= 1
