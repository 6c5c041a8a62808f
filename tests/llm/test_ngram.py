import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from voicecorpus.llm import ngram as G

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + ["\n"]


class Brute:
    def __init__(self, texts):
        self.c = [Counter(), Counter(), Counter()]
        for t in texts:
            w = ["<s>", *tokens(t)]
            for i in range(1, len(w)):
                self.c[0][w[i]] += 1
                self.c[1][(w[i - 1], w[i])] += 1
                if i > 1:
                    self.c[2][(w[i - 2], w[i - 1], w[i])] += 1
        self.n = sum(self.c[0].values())
        self.d = [None] + [G._discounts(np.array([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])) for c in self.c[1:]]
        self.total, self.cut = [defaultdict(float), defaultdict(float)], [defaultdict(float), defaultdict(float)]
        for k in (1, 2):
            for g, v in self.c[k].items():
                self.total[k - 1][g[:-1]] += v
                self.cut[k - 1][g[:-1]] += self.d[k][min(v, 3)]

    def p1(self, w):
        return (self.c[0][w] + 0.1) / (self.n + 0.1 * (len(self.c[0]) + 1))

    def p(self, k, g):
        lower = self.p1(g[-1]) if k == 1 else self.p(1, g[1:])
        t = self.total[k - 1][g[:-1]]
        if not t:
            return lower
        v = self.c[k][g]
        return (v - self.d[k][min(v, 3)]) / t + self.cut[k - 1][g[:-1]] / t * lower

    def score(self, text):
        w = ["<s>", *tokens(text)]
        return sum(math.log10(self.p(min(2, i), tuple(w[max(0, i - 2) : i + 1]))) for i in range(1, len(w)))


def data():
    rng = np.random.default_rng(9)
    rows = [(0, None), (1, ""), (2, "A b A b a B a b"), (3, "é \x0b É x " * 5)]
    for i in range(120):
        rows.append((10 + i, " ".join(f"w{int(x)}" for x in np.minimum(rng.zipf(1.4, int(rng.integers(1, 90))), 60))))
    return rows + [(500, rows[9][1]), (501, rows[9][1])]


@pytest.mark.parametrize("keys,chunk", [(1_000_000, 19), (300, 6)])
def test_scores_match_brute_force(spark, monkeypatch, keys, chunk):
    monkeypatch.setattr(G, "SHARD_KEYS", keys)
    rows = data()
    df = spark.createDataFrame([(d, t, "x", 1.0) for d, t in rows], "doc_id long, text string, score string, n_tokens double").repartition(3)
    train = [t for d, t in rows if d % 3]
    m = Brute(train)
    meta = G.train(df.where("doc_id % 3 <> 0"))
    assert meta["N"] == m.n and meta["V"] == len(m.c[0])
    got = {r.doc_id: r for r in G.score(df, meta).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        w = tokens(t)
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(m.c[0][x] > 0 for x in w), m.n)
        assert r.base_score == pytest.approx(sum(math.log10(m.p1(x)) for x in w))
        assert r.score == pytest.approx(m.score(t), abs=0.02 * len(w) + 1e-9)


def test_every_task_may_run_twice(spark, monkeypatch):
    """Building and finishing tasks whose first run was lost after it wrote leave the same trie."""
    monkeypatch.setattr(G, "SHARD_KEYS", 300)
    df = spark.createDataFrame(data(), "doc_id long, text string").repartition(3)
    score = lambda meta: sorted((r.doc_id, r.score) for r in G.score(df, meta).collect())
    once = score(G.train(df))
    merge, per_shard = G._merge, G._per_shard
    monkeypatch.setattr(G, "_merge", lambda c, n, build: merge(c, n, lambda *a: (build(*a), build(*a))[1]))
    monkeypatch.setattr(G, "_per_shard", lambda sp, names, work: (per_shard(sp, names, work), per_shard(sp, names, work))[1])
    meta = G.train(df)
    assert score(meta) == once
    import os

    left = os.listdir(meta["folder"])
    assert G.RAW not in left and not [x for x in left if x.startswith(".")]
    G.drop(spark, meta)
    assert not os.path.exists(meta["folder"])


def test_files_are_few_and_hold_no_descriptor(tmp_path):
    rng = np.random.default_rng(2)
    want = {}
    for i in range(60):
        want[i] = {"a": rng.integers(0, 255, 1000).astype(np.uint8), "b": rng.random(300), "none": np.zeros(0, np.int64)}
        G._save(str(tmp_path), f"x{i}", want[i])
    import os

    held = len(os.listdir("/proc/self/fd"))
    files = G._Files()
    got = {i: files(str(tmp_path), f"x{i}")[0] for i in want}
    assert files.opens == 60 and len(os.listdir("/proc/self/fd")) <= held + (60 if __import__("sys").version_info < (3, 13) else 0)
    assert all((got[i][k] == v).all() and got[i][k].dtype == v.dtype for i in want for k, v in want[i].items())
    assert len(os.listdir(tmp_path)) == 60


def test_files_of_a_folder_that_is_not_mounted(tmp_path, monkeypatch):
    from pyarrow import fs

    monkeypatch.setattr(G, "_fs", lambda folder: (fs.LocalFileSystem(), folder))
    monkeypatch.setattr(G, "OPEN_BYTES", 20_000)
    files, rng = G._Files(), np.random.default_rng(1)
    for i in range(9):
        a = rng.random(1000)
        for _ in range(2):  # a task that runs twice
            G._save(f"{tmp_path}/t", f"x{i}", {"a": a, "none": np.zeros(0, np.uint8)})
        got = files(f"{tmp_path}/t", f"x{i}")[0]
        assert (got["a"] == a).all() and not len(got["none"])
    assert len(files.held) == 2 and files.bytes <= 20_000 and files.opens == 9
    assert len(list((tmp_path / "t").iterdir())) == 9


def test_repeated_texts_score_above_single_ones(spark):
    rng = np.random.default_rng(11)
    text = lambda: " ".join(f"v{int(x)}" for x in rng.integers(0, 400, 60))
    once, twice = [text() for _ in range(60)], [text() for _ in range(30)]
    meta = G.train(spark.createDataFrame([(t,) for t in once + twice + twice], "text string"))
    rows = [(i, t) for i, t in enumerate(once + twice)] + [(1000, "long " * 300_000)]
    got = {r.doc_id: r.score / r.n_tokens for r in G.score(spark.createDataFrame(rows, "doc_id long, text string"), meta).collect()}
    assert max(got[i] for i in range(60)) < min(got[i] for i in range(60, 90)) and math.isfinite(got[1000])


def test_probabilities_sum_to_one():
    m = Brute([t for _, t in data()])
    for ctx in [("w1", "w2"), ("<s>", "w1"), ("zz", "w1"), ("zz", "yy")]:
        assert sum(m.p(2, (*ctx, w)) for w in m.c[0]) + m.p(2, (*ctx, "<unk>")) == pytest.approx(1)


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    meta = G.train(none)
    assert meta["N"] == 0 and G.score(none, meta).collect() == []
    r = G.score(spark.createDataFrame([(None, "a b")], "doc_id long, text string"), meta).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == r.score == 0


def test_blocks_and_codebooks():
    rng = np.random.default_rng(0)
    a, b = np.sort(rng.integers(0, 1 << 60, 500)).astype(np.uint64), rng.integers(0, 300, 500)
    x, y = G._expand(G._squeeze(a, b))
    assert x.tolist() == a.tolist() and y.tolist() == b.tolist()
    logs = np.concatenate((np.full(5000, -1.25), -rng.gamma(2, 1, 20_000)))
    code, book = G._quantise(logs)
    assert np.abs(book[code] - logs).max() < 0.5 and abs((book[code] - logs).mean()) < 1e-6 and np.abs(book[code][:5000] + 1.25).max() < 1e-6
