import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voicecorpus.llm import mixing as M


def waterfill(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        lam = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * lam > most * sizes[s]}
        if not over:
            goal |= {s: w[s] * lam for s in open_}
            break
        goal |= {s: most * sizes[s] for s in over}
        left -= sum(goal[s] for s in over)
        open_ -= over
    return goal


ROWS = [(i, "w " * (1 + i * 7 % 50), ["a", "b", None, "hot", "hot", "hot"][i % 6]) for i in range(240)]
ROWS += [(500, None, "a"), (501, "", "empty"), (502, " \t ", None), (3, "w w", "a"), (None, "q r s", "b")]


@pytest.mark.parametrize("block_docs", [1024, 8])
def test_targets_are_met_exactly(spark, block_docs):
    df = spark.createDataFrame([(d, t, s, 1, "z") for d, t, s in ROWS], "doc_id long, text string, source string, size int, target string")
    got = M.taken(df, block_docs=block_docs).collect()
    assert len(got) == len(ROWS)
    sizes, took, goal = Counter(), Counter(), {}
    source = {(d, len((t or "").split())): s for d, t, s in ROWS}
    for r in got:
        s = source[(r.doc_id, r.size)]
        sizes[s] += r.size
        took[s] += r.taken
        goal[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = waterfill(sizes)
    for s in sizes:
        assert goal[s] == pytest.approx(want[s])
        assert took[s] == math.floor(goal[s] + 0.5)
    again = M.taken(df.repartition(7), block_docs=block_docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_rows_hold_what_is_taken(spark):
    df = spark.createDataFrame([(d, t, s, len(t or ""), "b", 1, 2) for d, t, s in ROWS], "doc_id long, text string, source string, n_chars long, blocks string, rest int, target int")
    rows = M.mix(df, keep_plan=True, block_docs=8, shards=4).collect()
    by = Counter()
    for r in rows:
        n = len(re.findall(M.WORD, r.text))
        assert n == r.mix_words and 0 <= r.mix_shard < 4
        by[(r.doc_id, r.source)] += n
    want = Counter()
    src = {(d, len((t or "").split())): s for d, t, s in ROWS}
    for r in M.taken(df, block_docs=8, shards=4).collect():
        want[(r.doc_id, src[(r.doc_id, r.size)])] += r.taken
    assert by == +want
    assert M.mix(df, block_docs=8).columns == df.columns


@pytest.mark.parametrize("more", [0, 200])
def test_tree_splits_exactly_and_evenly(spark, more):
    d = {"a": 1000, "b": 10, "c": 333} | {f"s{j:03d}": 7 for j in range(more)}  # more than a row's worth of sources
    draws = spark.createDataFrame([(s, i, n) for i, (s, n) in enumerate(d.items())], "s string, i long, d long")
    rows = M.split_tree(draws, 3).collect()
    by, shard = Counter(), Counter()
    for r in rows:
        assert r.d > 0
        by[r.s] += r.d
        shard[r.shard] += r.d
    assert by == d
    assert set(shard) == set(range(8)) and max(shard.values()) - min(shard.values()) <= 1
    assert 95 < min(r.d for r in rows if r.s == "a") and max(r.d for r in rows if r.s == "a") < 155


@pytest.mark.parametrize("block_docs", [1024, 8])
def test_plan_matches_sql(spark, block_docs):
    import duckdb

    rows = [r for r in ROWS if r[0] is not None] + [(None, f"u v {i}", "hot") for i in range(30)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = Counter(con.execute("SELECT doc_id, size, source_size, taken, shards FROM (" + M.oracle_sql(block_docs) + ")").fetchall())
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = Counter((r.doc_id, r.size, r.source_size, r.taken, r.shards) for r in M.taken(df, block_docs=block_docs).collect())
    assert got == want and len({x.split(":")[1] for r in got for x in r[4].split(",") if x}) == 8


def test_running_sums_by_spans(spark):
    rows = [(k, b, (b * 7 + 3) % 11) for k in "xy" for b in range(100)]
    d = spark.createDataFrame(rows, "k string, b long, v long").repartition(4)
    got = {(r.k, r.b): r.before for r in M._before(d, F.floor(F.col("b") / 8), ["b"], F.col("v")).collect()}
    assert got == {(k, b): sum(w for l, c, w in rows if l == k and c < b) for k, b, _ in rows}


def test_texts_of_one_id_and_clashing_names(spark):
    names = "doc_id long, text string, source string, row string, k int, size string, h int, words int, copies string, c int, w int, o int, b int"
    rows = [(1, f"w{i} x y", "a", "r", 1, "s", 2, 3, "c", 4, 5, 6, 7) for i in range(9)] + [(2, "long " * 200_000, "b", *rows_tail())]
    df = spark.createDataFrame(rows, names)
    out = [M.mix(d).collect() for d in (df, df.repartition(6))]
    assert M.mix(df).columns == df.columns
    assert Counter(map(tuple, out[0])) == Counter(map(tuple, out[1]))
    assert all(r.k == 1 and r.size == "s" and r.copies == "c" for r in out[0])


def rows_tail():
    return "r", 1, "s", 2, 3, "c", 4, 5, 6, 7


def test_hypergeometric_draw_has_its_distribution(spark):
    u = "((id + 0.5D) / 20000D)"
    got = Counter(r.x for r in spark.range(20000).selectExpr(f"{M._hyper('7L', '20L', '9L', u)} as x").collect())
    for x in range(8):
        p = math.comb(7, x) * math.comb(13, 9 - x) / math.comb(20, 9)
        assert abs(got[x] / 20000 - p) < 2e-4


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.taken(df).collect() == [] and M.mix(df).collect() == []
