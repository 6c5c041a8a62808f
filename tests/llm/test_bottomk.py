import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from voicecorpus.llm import bottomk as B

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_sketch(text, k=B.K, size=B.SHINGLE):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    w = WORD.findall(low)
    sh = {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    return sorted({xxhash.xxh64_intdigest(s, 42) >> 16 for s in sh})[:k]


def brute_near(a, b, k=B.K):
    if not a or not b:
        return float(len(a) == len(b))
    u = sorted(set(a) | set(b))[:k]
    return len(set(a) & set(b) & set(u)) / len(u)


def rows():
    rng = np.random.default_rng(5)
    out = [(10, None), (11, ""), (12, "Éa b"), (13, "🙂🙂🙂 x"), (14, " \n")]
    for i in range(60):
        out.append((20 + 3 * i, " ".join(f"W{x}" for x in rng.integers(0, 40, int(rng.integers(1, 400))))))
    out += [(400, out[20][1]), (401, "long " * 30000)]
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_results_match_brute_force(spark, parts):
    data = rows()
    df = spark.createDataFrame([(d, t, 1, 0) for d, t in data], "doc_id long, text string, part int, ghost int").repartition(3)
    got = {r.doc_id: r for r in B.compare_neighbours(df, parts=parts).collect()}
    assert len(got) == len(data)
    for i, (d, t) in enumerate(data):
        t, nxt = t or "", data[(i + 1) % len(data)][1] or ""
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = got[d]
        a, b, c = brute_sketch(t), brute_sketch(e), brute_sketch(nxt)
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert B.decode(r.fingerprint).tolist() == a and B.decode(r.edited_fingerprint).tolist() == b
        assert r.near_edited == pytest.approx(brute_near(a, b)) and r.near_next == pytest.approx(brute_near(a, c))


def test_estimates():
    x = pa.array([" ".join(f"a{i}" for i in range(3000)), " ".join(f"a{i}" for i in range(1500, 4500))])
    a, b = B.sketches(x, 1024)
    assert abs(B.resemblance(a, b, 1024) - 1496 / 4496) < 0.06
    assert abs(B.containment(a, b, 1024) - 0.5) < 0.08
    assert abs(B.distinct(a, 1024) / 2996 - 1) < 0.12
    assert B.merge(a, b, k=1024).tolist() == sorted({*a.tolist(), *b.tolist()})[:1024]


def test_merge_by_key(spark):
    docs = [(i, " ".join(f"v{(i * 31 + j) % 900}" for j in range(60)), "hot" if i % 3 else None) for i in range(90)]
    fp = {r.doc_id: r.fingerprint for r in B.fingerprint(spark.createDataFrame(docs, "doc_id long, text string, g string")).collect()}
    df = spark.createDataFrame([(g, fp[i]) for i, _, g in docs] + [("e", None)], "g string, fingerprint string").repartition(5)
    got = {r.g: B.decode(r.fingerprint).tolist() for r in B.merge_by(df, "g").collect()}
    for g in ("hot", None):
        assert got[g] == B.merge(*[B.decode(fp[i]) for i, _, x in docs if x == g]).tolist()
    assert got["e"] == []


def test_edges(spark):
    assert B.compare_neighbours(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    r = B.compare_neighbours(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).first()
    assert r.near_next == 1.0
    two = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y"), (None, None)], "doc_id long, text string")
    assert sorted((r.n_chars, r.near_next) for r in B.compare_neighbours(two, parts=2).collect()) == [(0, 0.0), (1, 0.0), (1, 0.0), (1, 1.0)]


@pytest.mark.parametrize("parts", [1, 9])
def test_hot_and_missing_ids_are_cut_by_text(spark, parts):
    rng = np.random.default_rng(6)
    t = lambda: " ".join(f"q{x}" for x in rng.integers(0, 300, 40))
    data = [(None, t()) for _ in range(60)] + [(77, t()) for _ in range(90)] + [(i, t()) for i in range(40, 110)] + [(77, "same"), (77, "same")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    th = lambda s: xxhash.xxh64_intdigest(s.encode(), 42) >> 11
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, th(r[1]), r[1]))
    want = []
    for i, (d, s) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        e = s[: len(s) - len(s) // 2] + nxt[: len(s) // 2]
        want.append((d, hashlib.sha256(e.encode()).hexdigest()))
    got = B.compare_neighbours(df, parts=parts)
    assert sorted(((r.doc_id, r.edited_sha256) for r in got.collect()), key=str) == sorted(want, key=str)
