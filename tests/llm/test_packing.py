import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from voicecorpus.llm import packing as P

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_tokenizers(text):
    assert P.encode(text) == TOK.encode(text, add_special_tokens=False).ids


def test_special_string_and_latin():
    for t in ("a<|endoftext|>b", "Größe 12,5 – ça", "  x\n\n y\t", "ɐ漢字"):
        assert P.encode(t) == TOK.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_bins_hold_all_and_no_more(size):
    bins = P.pack(size, 40)
    assert sorted(i for b in bins for i in b) == list(range(len(size)))
    assert all(0 < sum(size[i] for i in b) <= 40 for b in bins)


def test_search_empties_bins():
    rng = np.random.default_rng(1)
    size = [x for a, b in zip(rng.integers(260, 400, 400).tolist(), rng.integers(260, 360, 400).tolist(), strict=True) for x in (a, b, 1024 - a - b)]
    b = P.Bins(size, 1024)
    b.best_fit()
    before, squares = len(b.bins), sum((1024 - r) ** 2 for r in b.room)
    b.search()
    assert sum(map(bool, b.bins)) < before and sum((1024 - r) ** 2 for r, x in zip(b.room, b.bins, strict=True) if x) > squares


def test_cut_points():
    assert P.cut_points(1, 4) == [0, 1] and P.cut_points(4, 4) == [0, 4] and P.cut_points(8, 4) == [0, 4, 8] and P.cut_points(9, 4) == [0, 1, 5, 9]


@pytest.mark.parametrize("task_pieces", [25_000, 20])
def test_packed_documents(spark, task_pieces):
    rows = [(0, None), (1, ""), (2, "word " * 5000), (None, "x"), (3, "same"), (3, "same")] + [(10 + i, "abc é " * (i * 13 % 170)) for i in range(120)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, piece string, length int").repartition(3)
    got = P.packed(df, task_pieces=task_pieces, keep_ids=True).collect()
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 1024
    for d, t in rows:
        want = TOK.encode(t or "", add_special_tokens=False).ids + [2]
        ps = sorted(docs[d], key=lambda r: (r.start, r.sequence_id))
        if d != 3:
            assert sum((r.ids for r in ps), []) == want and [r.piece for r in ps] == list(range(len(ps)))
        else:
            assert [r.ids for r in ps] == [want, want]
        assert len(want) <= 1024 and len(ps) == (2 if d == 3 else 1) or all(r.length == 1024 for r in ps[1:])
    total = sum(r.length for r in got)
    assert len(seqs) <= -(-total // 1024) + 1 + (task_pieces == 20) * 8
    again = P.packed(df, task_pieces=task_pieces).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in P.packed(df, task_pieces=task_pieces).collect())


def test_empty_table(spark):
    assert P.packed(spark.createDataFrame([], "doc_id long, text string")).collect() == []
