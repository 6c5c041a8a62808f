"""The pipeline's stages on a small fixture, each against a plain version of its rule."""

import math
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from tests.llm.test_simhash import brute_components
from voicecorpus.llm import langid, toxicity
from voicecorpus.llm.packing import encode


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    top = tmp_path_factory.mktemp("stages")
    out = [docs]
    for k, (_, f) in enumerate(P.STAGES):
        f(spark, out[-1], sf).write.parquet(f"{top}/{k}")
        out.append(spark.read.parquet(f"{top}/{k}"))
    return [d.collect() for d in out], [d.columns for d in out]


def test_columns_and_order():
    assert [n for n, _ in P.STAGES] == ["language", "toxicity", "near_duplicates", "mixing", "packing"]


def test_each_stage(spark, stages):
    rows, columns = stages
    assert all(c == columns[0] for c in columns[:-1])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = langid.train(docs)
    scored = list(zip(rows[0], *m.score([r.text for r in rows[0]]), strict=True))
    assert {(r.doc_id, r.lang) for r in rows[1]} == {(r.doc_id, lang) for r, lang, s in scored if lang != "und" and s >= langid.MIN_SCORE}
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    t = toxicity.train(spark.createDataFrame(rows[1], docs.schema), labels)
    assert {r.doc_id for r in rows[2]} == {r.doc_id for r, s in zip(rows[1], t.score([r.text for r in rows[1]]), strict=True) if s < 0.5}
    assert sorted(r.doc_id for r in rows[3]) == sorted({c for _, _, c in brute_components([(r.doc_id, r.text) for r in rows[2]])})
    size, took = Counter(), Counter()
    for r in rows[3]:
        size[r.source] += len(r.text.split())
    for r in rows[4]:
        took[r.source] += len(r.text.split())
    assert sum(took.values()) == pytest.approx(1.5 * sum(size.values()), abs=len(size)) and all(took[s] <= 2 * size[s] for s in size)
    want = Counter()
    for r in rows[4]:
        n = len(encode(r.text)) + 1
        want[r.doc_id] += n
    got, seqs = Counter(), defaultdict(int)
    for r in rows[5]:
        got[r.doc_id] += r.length
        seqs[r.sequence_id] += r.length
    assert got == want and max(seqs.values()) <= 1024
    assert len(seqs) <= math.ceil(sum(want.values()) / 1024) * 1.05 + 1


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeats and columns with clashing names."""
    text = "the thing is that the other was not with the house and they were there in the end " * 3
    de = "der hund und die katze sind nicht in dem haus und das ist nicht schön für die kinder " * 3
    solo = "this was one that had nothing of the others in it and that they were all without when it was over"
    rows = [(i, f"{text} {i} word{i} only", "en", f"s{i % 2}", 10, 1, "c") for i in range(30)]
    rows += [(100 + i, f"{de} {i} wort{i} nur", "de", None, 10, 1, "c") for i in range(30)]
    rows += [(200, solo, None, "s0", 10, 1, "c"), (200, solo, None, "s0", 10, 1, "c"), (None, solo, None, "s1", 10, 1, "c"), (201, None, "en", "s0", None, 1, None), (202, "", "de", None, 0, 1, "c"), (203, "12 34 ...", "en", "s0", 9, 1, "c")]
    rows += [(204, "the house and the other thing " * 60_000, None, "s1", 10, 1, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int, row string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for k, (name, f) in enumerate(P.STAGES):
        f(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}-{name}")
        was, now = now, spark.read.parquet(f"{tmp_path}/{k}-{name}")
        if k < 4:
            assert now.columns == docs.columns
        if name == "language":
            kept = now.collect()
            assert not {201, 202, 203} & {r.doc_id for r in kept} and len(kept) == len(rows) - 3
            assert {r.lang for r in kept if (r.doc_id or 0) < 30 or r.doc_id in (200, 204)} == {"en"} and {r.lang for r in kept if 100 <= (r.doc_id or 0) < 130} == {"de"}
        if name == "toxicity":
            assert now.count() == was.count()
        if name == "near_duplicates":
            assert [r.doc_id for r in now.where(f"text = '{solo}'").collect()] == [200] and now.where("doc_id = 204").count() == 1
    pieces = now.collect()
    assert max(r.length for r in pieces) <= 1024 and {r.doc_id for r in pieces} <= {r.doc_id for r in was.collect()}
    empty = docs.limit(0)
    for _, f in P.STAGES[:-1]:
        assert f(spark, empty, str(tmp_path)).collect() == []
    assert P.STAGES[-1][1](spark, empty, str(tmp_path)).collect() == []


def test_run_leaves_no_folder(spark):
    import os

    from voicecorpus.llm.shared import shared_dir

    P.run(spark, "/root/testdata/sf0.001")
    assert not [x for x in os.listdir(shared_dir(spark)) if x.startswith("pipeline-")]
