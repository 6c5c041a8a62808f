import random

import pytest
from pyspark.sql import functions as F

from voicecorpus.functions import text as T
from voicecorpus.operators import alignment, evaluate, export, quality, review, segments

WORDS = "array<struct<start:double,end:double,word:string,prob:double>>"


def align(spark, sentences, words, chapters=None):
    s = spark.createDataFrame([("b", f"b_s{i:05d}", i, t, t) for i, t in enumerate(sentences)], "book_id string, sent_id string, `order` int, text string, normalized string")
    s = s.withColumn("tokens", T.tokenize(F.col("text")))
    c = chapters or [("c1", 0, words)]
    c = spark.createDataFrame([("b", k, o, [(a, e, w, 1.0) for w, a, e in ws]) for k, o, ws in c], f"book_id string, chapter_id string, `order` int, words {WORDS}")
    return {r.seg_id[-1]: (r.start, r.end, r.score, r.chapter_id) for r in alignment.BridgeAligner().align(s, c).collect()}


def test_alignment_cases(spark):
    got = align(spark, ["Dobrý den.", "Jak se máš?"], [("dobry", 0.0, 0.4), ("den", 0.5, 1.0), ("jak", 1.5, 1.7), ("se", 1.7, 1.9), ("máš", 2.0, 2.4)])
    assert got == {"0": (0.0, 1.0, 1.0, "c1"), "1": (1.5, 2.4, 1.0, "c1")}
    assert align(spark, ["zelený vysoký strom modrá"], [("zelený", 0.0, 0.4), ("vysoký", 0.4, 0.8)])["0"][2] == 0.5
    tail = align(spark, ["zelený vysoký strom modrá", "malá kočka"], [("zelený", 0.0, 0.4), ("vysoký", 0.4, 0.8), ("strom", 0.8, 1.2), ("modrák", 1.2, 1.6), ("malá", 2.5, 2.8), ("kočka", 2.8, 3.0)])
    assert tail["0"][:3] == (0.0, 1.6, 0.75) and tail["1"][0] == 2.5
    pause = align(spark, ["zelený vysoký strom"], [("zelený", 0.0, 0.5), ("vysoký", 0.5, 1.5), ("cizí", 2.26, 2.6)])
    assert pause["0"][1] == 1.5
    head = align(spark, ["zelený vysoký strom"], [("zelenej", 0.0, 0.5), ("vysoký", 0.5, 1.0), ("strom", 1.0, 1.4)])
    assert head["0"][0] == 0.0
    two = align(spark, ["zelený vysoký", "strom"], None, [("c2", 1, [("strom", 0.0, 0.3)]), ("c1", 0, [("zelený", 0.0, 0.3), ("vysoký", 0.3, 0.6)])])
    assert two == {"0": (0.0, 0.6, 1.0, "c1"), "1": (0.0, 0.3, 1.0, "c2")}


def test_aligner_choice():
    with pytest.raises(ValueError):
        alignment.get_aligner("other")
    with pytest.raises(NotImplementedError):
        alignment.get_aligner("forced").align(None, None)


def plain_merge(segs, lo=1.0, hi=15.0, gap=1.0):
    out, cur = [], None
    for s in sorted(segs):
        if cur and cur[2] - cur[0] < lo and s[0] - cur[2] <= gap and s[2] - cur[0] <= hi:
            cur = (cur[0], cur[1], s[2], round((cur[3] + s[3]) / 2, 3))
        else:
            if cur:
                out.append(cur)
            cur = s
    return out + ([cur] if cur else [])


def test_merge_matches_a_fold(spark):
    rng = random.Random(2)
    rows = []
    for k in range(30):
        t = 0.0
        for i in range(rng.randint(0, 25)):
            t = round(t + rng.choice([0.0, 0.1, 0.5, 1.0, 1.5]), 2)
            e = round(t + rng.choice([0.2, 0.5, 0.9, 1.2, 14.5]), 2)
            rows.append((k, i, t, e, rng.randint(0, 8) / 8))
            t = e
    df = spark.createDataFrame([(k, i, f"{i}", t, e, s, "x", "y") for k, i, t, e, s in rows], "k int, rank int, seg_id string, start double, end double, score double, text string, normalized string")
    got = {}
    for r in segments.merge_short(df, ["k"]).collect():
        got.setdefault(r.k, []).append((r.start, int(r.seg_id), r.end, r.score))
    for k in range(30):
        want = plain_merge([(t, i, e, s) for kk, i, t, e, s in rows if kk == k])
        assert [x[:3] for x in sorted(got.get(k, []))] == [x[:3] for x in want]
        assert [x[3] for x in sorted(got.get(k, []))] == pytest.approx([x[3] for x in want], abs=2e-3)


def test_clips_are_snapped_padded_and_numbered_before_empty_ones_go(spark):
    df = spark.createDataFrame(
        [("b", "c", "s1", "t", "t", 0.6, 1.9, 1.0, 5.0, [(0.5, 2.0), (3.1, 4.4)]), ("b", "c", "s2", "t", "t", 6.0, 6.0, 1.0, 5.0, []), ("b", "c", "s3", "t", "t", 9.0, 9.5, 1.0, 20.0, [])],
        "book_id string, chapter_id string, seg_id string, text string, normalized string, start double, end double, score double, chapter_duration double, regions array<struct<start:double,end:double>>",
    )
    got = [(r.clip_id, r.start, r.end) for r in segments.cut_clips(df).orderBy("clip_id").collect()]
    assert got == [("c_0000", 0.4, 2.1), ("c_0002", 8.9, 9.6)]
    with pytest.raises(ValueError):
        segments.cut_clips(df, detector="other")


def test_grading(spark):
    base = {"duration": 5.0, "peak": 0.5, "silence_ratio": 0.1, "snr_db": 30.0, "edge_lead_ms": 0.0, "edge_tail_ms": 0.0, "cer": None}
    cases = [({}, [], "pass"), ({"duration": 0.5}, ["duration"], "reject"), ({"peak": 0.99896}, ["clipping"], "review"), ({"silence_ratio": 0.6}, ["silence"], "reject"), ({"snr_db": 9.994}, ["low_snr"], "review"), ({"edge_tail_ms": 40.0}, ["edge_noise"], "review"), ({"cer": 0.15}, ["cer_review"], "review"), ({"cer": 0.25, "snr_db": 1.0}, ["low_snr", "cer_high"], "reject"), ({"peak": None}, [], "pass")]
    rows = [(i, *(base | c).values()) for i, (c, _, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{k} double" for k in base))
    got = quality.grade(df).orderBy("i").collect()
    assert [(r.flags, r.status) for r in got] == [(f, s) for _, f, s in cases]
    assert quality.status_counts(quality.grade(df)).first().asDict() == {"clips": 9, "pass": 2, "review": 4, "reject": 3}


def test_review(spark):
    clips = spark.createDataFrame([("a", "pass", ["x"]), ("b", "review", []), ("c", "review", []), ("d", "reject", [])], "clip_id string, status string, flags array<string>")
    v = spark.createDataFrame([("b", "approve", ""), ("a", "reject", ""), ("d", "approve", ""), ("zz", "reject", "")], "clip_id string, verdict string, flags string")
    done = review.apply_verdicts(clips, v)
    assert {r.clip_id: r.status for r in done.collect()} == {"a": "reject", "b": "pass", "c": "review", "d": "reject"}
    assert review.outcome(clips, v).first().asDict() == {"approved": 1, "rejected": 1, "stale": 1}
    again = review.apply_verdicts(done.drop("status_before"), v)
    assert {r.clip_id: r.status for r in again.collect()} == {r.clip_id: r.status for r in done.collect()}
    bad = v.withColumn("verdict", F.lit("maybe")).withColumn("seq", F.lit(1).cast("long"))
    with pytest.raises(ValueError):
        review.upsert(v, bad)


def test_export(spark):
    assert sorted(export.held_rows(1)) == [0] and len(export.held_rows(250)) == 5 and export.held_rows(100) == export.held_rows(100)
    rows = spark.createDataFrame([(f"c{i}", "a|b", "n|m", "s", float(i)) for i in range(100)], "clip_id string, text string, normalized string, speaker_id string, duration double")
    for f in (export.split_ranked(rows), export.split_shuffled(rows, ["clip_id"])):
        assert f.where("split = 'val'").count() == 2 and f.count() == 100
    assert export.metadata_lines(rows, "piper").first().line == "c0.wav|a b" and export.metadata_lines(rows, "ljspeech").first().line == "c0|a b|n m"
    with pytest.raises(ValueError):
        export.metadata_lines(rows, "x")
    s = export.statistics(rows).first()
    assert (s.clips, s.char_inventory, s.char_count, s.speakers, s.duration_max) == (100, "ab|", 3, ["s"], 99.0)
    assert export.statistics(rows.limit(0)).first().clips == 0


def test_reports(spark):
    seg = spark.createDataFrame([("x", 0.0, 2.0, 1.0), ("x", 3.0, 6.0, 0.8)], "strategy string, start double, end double, score double")
    m = evaluate.basic_metrics(seg, 10.0)
    r = m.first()
    assert (r.segments, r.audio_seconds, r.retained_pct, r.mean_score, r.dur_max) == (2, 5.0, 50.0, 0.9, 3.0)
    rows = [x.asDict() for x in evaluate.report(m).collect()]
    assert {x["metric"]: x["x"] for x in rows}["retained_pct"] == 50.0
    assert evaluate.format_report(rows, ["x"]).splitlines()[0] == "metric              x               " and evaluate.format_report([], []) == "(no strategies to compare)"
    f = spark.createDataFrame([([0.0, 1.0, 0.0, 0.0], 0.5), ([0.0], 0.5)], "rms array<double>, threshold double")
    assert evaluate.boundary_metrics(f, 20, 1000).first() == (0.02, 0.04)
    assert evaluate.boundary_metrics(f.limit(0), 20, 1000).first() == (None, None)
