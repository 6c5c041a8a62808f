import re

import numpy as np
import pyarrow as pa
import xxhash

from voicecorpus.llm import simhash as S
from voicecorpus.llm.textops import words, xxh64

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_fp(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    w = WORD.findall(low)
    sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), d), d)
    return [(d, fps[i], best[find(i)]) for i, (d, _) in enumerate(rows)]


def test_xxh64_matches_library():
    rng = np.random.default_rng(1)
    buf = np.concatenate((rng.integers(0, 256, 5000).astype(np.uint8), np.zeros(8, np.uint8)))
    a = rng.integers(0, 4000, 600)
    b = a + rng.integers(0, 900, 600)
    got = xxh64(buf, a, b)
    assert got.tolist() == [xxhash.xxh64_intdigest(buf[x:y].tobytes(), 42) for x, y in zip(a, b, strict=True)]


def test_words_edges():
    w = words(pa.array(["", "Ab  c\t", None, "d", "\x0b", "É F"]))
    got = [bytes(w.buf[s:e]).decode() for s, e in zip(w.start, w.end, strict=True)]
    assert got == ["ab", "c", "d", "É", "f"] and w.doc.tolist() == [1, 1, 3, 5, 5]


def test_masks_cover_every_pattern_of_four_bits():
    ms = S.masks(4)
    rng = np.random.default_rng(2)
    assert len(ms) == 31
    for _ in range(2000):
        diff = sum(1 << int(i) for i in rng.choice(64, 4, replace=False))
        assert any(m & diff == 0 for m in ms)


def texts():
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "A b"), (4, "a B"), (5, "x " * 3000)]
    for i in range(40):
        base = [vocab[k] for k in rng.integers(0, 300, 120)]
        for c in range(4):
            t = list(base)
            for _ in range(c):
                t[int(rng.integers(0, 120))] = "zz"
            rows.append((1000 - len(rows), " ".join(t)))
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, fp string, component_id int")
    want = sorted(brute_components(rows))
    for small in (1024, 1):  # compared within tasks, or by shared points
        got = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in S.near_duplicates(df, small=small).collect())
        assert got == want
    kept = {r.doc_id for r in S.keep_one(df).collect()}
    assert kept == {c for _, _, c in want}


def test_empty_table_repeats_and_null_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).collect() == []
    df = spark.createDataFrame([(5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "q")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (None, None)], key=str)


def kept_of(spark, rows, columns="doc_id long, text string"):
    return sorted(map(tuple, S.keep_one(spark.createDataFrame(rows, columns)).collect()), key=str)


def test_keep_one_keeps_every_text_of_its_own(spark):
    a, b, c = "one two three four five", "six seven eight nine ten", "p q r s t u"
    # an id that stands for copies of another's text and for a text of its own
    assert kept_of(spark, [(1, a), (5, a), (5, b)]) == [(1, a), (5, b)]
    # one id over two texts that nothing links, and a copy of either
    assert kept_of(spark, [(5, a), (5, b), (7, a), (8, b)]) == [(5, a), (5, b)]
    # rows without an id: of a component of their own one stays, else the one with an id
    assert kept_of(spark, [(None, a), (None, a), (None, b), (3, b), (None, c)]) == sorted([(None, a), (3, b), (None, c)], key=str)
    # repeated rows, and columns with the names that the work inside uses
    rows = [(1, a, "x", 2, 3, {"k": 1})] * 3 + [(1, a, "w", 2, 3, {"k": 1}), (2, None, "x", 0, 0, None), (3, "", "y", 0, 0, None)]
    names = "doc_id long, text string, row string, n int, times int, th map<string,int>"
    assert kept_of(spark, rows, names) == sorted([rows[3], rows[4]], key=str)
    assert S.keep_one(spark.createDataFrame([], names)).collect() == []


def test_repeated_ids_join_no_texts(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "e f g h"), (2, "a b c d"), (3, "e f g h"), (2, "u v w x")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.fp == S.np.int64(brute_fp("e f g h").__index__() - (1 << 64) if brute_fp("e f g h") >> 63 else brute_fp("e f g h"))) for r in S.near_duplicates(df).collect())
    assert got == sorted([(1, 1, False), (2, 1, False), (2, 2, True), (3, 2, True), (2, 2, False)])


def test_components_of_long_chains_and_stars(spark):
    from voicecorpus.llm.graph import components

    edges = [(i, i + 1) for i in range(70)] + [(500, i) for i in range(501, 560)] + [(900, 900), (None, 3)] + [(700, 701)] * 3
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(71)} | {i: 500 for i in range(500, 560)} | {700: 700, 701: 700}
    assert got == want
