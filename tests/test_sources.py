import json

import numpy as np
import pytest

from voicecorpus import config, schemas
from voicecorpus.plans import pipeline
from voicecorpus.sources import audio, records
from voicecorpus.streaming import grading


def test_config(tmp_path):
    c = config.load()
    assert c.get("align.min_score") == 0.7 and c.get("no.such", 5) == 5
    with pytest.raises(KeyError):
        c.require("no.such")
    (tmp_path / "c.yaml").write_text("align:\n  min_score: 0.5\n")
    d = config.load(str(tmp_path / "c.yaml"))
    assert d.get("align.min_score") == 0.5 and d.get("align.strategy") == "asr_bridge"
    d.data["align"]["min_score"] = 9
    assert d.get("align.min_score") == 0.5


def test_jsonl(spark, tmp_path):
    p = str(tmp_path / "m")
    assert records.read_jsonl(spark, p, schemas.VERDICT).count() == 0
    df = spark.createDataFrame([("ž", None, "a|b")], schemas.VERDICT)
    assert records.write_jsonl(df, p) == 1 and records.append_jsonl(df, p) == 1
    assert '"verdict":null' in "".join(f.read_text() for f in (tmp_path / "m").glob("part*"))
    back = records.read_jsonl(spark, p, schemas.VERDICT)
    assert [tuple(r) for r in records.iter_jsonl(spark, p, schemas.VERDICT)] == [("ž", None, "a|b")] * 2
    assert records.replace_jsonl(back.limit(1), p) == 1 and records.read_jsonl(spark, p, schemas.VERDICT).count() == 1
    records.write_json({"ž": 1}, str(tmp_path / "x" / "d.json"))
    assert json.loads((tmp_path / "x" / "d.json").read_text()) == {"ž": 1}


def test_verdict_file_keeps_the_last(spark, tmp_path):
    p = str(tmp_path / "v.csv")
    assert records.read_verdicts(spark, p).count() == 0
    new = lambda rows: spark.createDataFrame([(c, v, "", i) for i, (c, v) in enumerate(rows)], "clip_id string, verdict string, flags string, seq long")
    records.save_verdicts(new([("b", "approve"), ("a", "reject"), ("b", "reject")]), p)
    records.save_verdicts(new([("a", "approve")]), p)
    assert [(r.clip_id, r.verdict) for r in records.read_verdicts(spark, p).orderBy("clip_id").collect()] == [("a", "approve"), ("b", "reject")]


def test_metadata_and_clips(spark, tmp_path):
    (tmp_path / "metadata.csv").write_text("c1.wav|Text, \"a\"\n|none\nc2|b|n\n")
    got = records.read_clips(spark, str(tmp_path / "metadata.csv"), schemas.CHECKED).collect()
    assert [(r.clip_id, r.text) for r in got] == [("c1", 'Text, "a"'), ("c2", "b")] and got[0].wav.endswith("/wavs/c1.wav")
    (tmp_path / "f.csv").write_text("clip_id,status\nx,review\n")
    assert records.read_clips(spark, str(tmp_path / "f.csv"), schemas.CHECKED).first().status == "review"


@pytest.fixture
def raw(tmp_path):
    for b in ("one", "two"):
        (tmp_path / "raw" / b / "audio").mkdir(parents=True)
        (tmp_path / "raw" / b / "book.txt").write_text("První věta. Druhá věta!\n\nTřetí.")
    x = np.sin(np.arange(8000) / 10) * 0.5
    for n in ("02.wav", "01.WAV"):
        (tmp_path / "raw" / "one" / "audio" / n).write_bytes(audio.encode(x, 8000))
    (tmp_path / "raw" / "one" / "audio" / "notes.txt").write_text("x")
    return tmp_path


def test_books_chapters_and_audio(spark, raw):
    assert {r.book_id for r in records.books(spark, str(raw / "raw")).collect()} == {"one", "two"}
    assert records.books(spark, str(raw / "none")).count() == 0
    f = records.chapter_files(spark, str(raw / "raw"), content=True)
    got = audio.probed(f).orderBy("order").collect()
    assert [(r.chapter_id, r.order, r.duration, r.codec, r.sample_rate, r.channels) for r in got] == [("01", 0, 1.0, "pcm_s16le", 8000, 1), ("02", 1, 1.0, "pcm_s16le", 8000, 1)]
    s = audio.samples(f).selectExpr("chapter_id as clip_id", "sr", "samples")
    out = audio.write_wavs(s, str(raw / "wavs"), 4000).collect()
    x, sr = audio.decode(open(out[0].wav, "rb").read())
    assert sr == 4000 and len(x) == 4000 and abs(np.abs(x).max() - 0.5) < 0.01
    assert audio.probe(b"none")["codec"] is None


def test_pipeline_and_review(spark, raw):
    cfg = config.Config(config.deep_merge(config.DEFAULTS, {"paths": {"raw": str(raw / "raw"), "work": str(raw / "work")}, "align": {"min_score": 0.1}}))
    assert pipeline.run(spark, cfg, stage="ingest") == {"ingest": 2} and pipeline.run(spark, cfg, stage="text_prep") == {"text_prep": 6}
    assert pipeline.run(spark, cfg, stage="ingest") == {"ingest": None} and pipeline.run(spark, cfg, stage="ingest", force=True) == {"ingest": 2}
    with pytest.raises(ValueError):
        pipeline.run(spark, cfg, stage="none")
    ch = records.read_jsonl(spark, cfg.stage_path("ingest"), schemas.CHAPTER)
    assert {(r.book_id, r.codec, r.src_sample_rate, r.sample_rate_asr, r.sample_rate_master) for r in ch.collect()} == {("one", "pcm_s16le", 8000, 16000, 22050)}
    words = [(0.0, 0.4, "první", 1.0), (0.4, 0.9, "věta", 1.0)]
    heard = ch.where("chapter_id = '01'").crossJoin(spark.createDataFrame([("t", words)], f"asr_text string, words {schemas.WORDS}"))
    records.write_by_book(heard, cfg.stage_path("transcribe"))
    with pytest.raises(FileNotFoundError):  # the other book was not transcribed
        pipeline.run(spark, cfg, stage="align")
    assert pipeline.run(spark, cfg, stage="align", book="one") == {"align": 1} and pipeline.run(spark, cfg, stage="segment", book="one") == {"segment": 1}
    assert spark.read.json(cfg.stage_path("segment")).first().clip_id == "01_0000"
    checked = str(raw / "work" / "checked")
    with pytest.raises(FileNotFoundError):
        pipeline.apply_review(spark, checked, str(raw / "v.csv"), str(raw / "flagged"))
    clips = spark.createDataFrame([("a", "review"), ("b", "pass")], "clip_id string, status string")
    for c in [x for x in spark.createDataFrame([], schemas.CHECKED).columns if x not in clips.columns]:
        clips = clips.selectExpr("*", f"cast(null as {spark.createDataFrame([], schemas.CHECKED).schema[c].dataType.simpleString()}) as `{c}`")
    records.write_jsonl(clips, checked)
    assert pipeline.apply_review(spark, checked, str(raw / "v.csv"), str(raw / "flagged")) is None
    (raw / "v.csv").write_text("clip_id,verdict,flags\na,approve,\nb,reject,\n")
    assert pipeline.apply_review(spark, checked, str(raw / "v.csv"), str(raw / "flagged")) == {"approved": 1, "rejected": 1, "stale": 0}
    assert {r.clip_id: r.status for r in records.read_jsonl(spark, checked, schemas.CHECKED).collect()} == {"a": "pass", "b": "reject"}
    assert spark.read.option("header", True).csv(str(raw / "flagged")).columns == schemas.FLAGGED


def test_streams(spark, tmp_path):
    schema = "clip_id string, duration double, peak double, silence_ratio double, snr_db double"
    src = str(tmp_path / "in")
    for i, d in enumerate((0.5, 5.0)):
        spark.createDataFrame([(f"c{i}", d, 0.1, 0.1, 20.0)], schema).write.mode("append").json(src)
        grading.grade_stream(spark, src, schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {r.clip_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"c0": "reject", "c1": "pass"}
    s = "key string, start double, end double"
    seg = str(tmp_path / "seg")
    spark.createDataFrame([("k", 0.0, 1.0), ("k", 1.5, 2.0), ("k", 9.0, 9.5), ("m", 0.0, 1.0)], s).write.json(seg)
    q = grading.pause_groups(spark.readStream.schema(s).json(seg)).writeStream.format("memory").queryName("runs").option("checkpointLocation", str(tmp_path / "cp2")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [tuple(r) for r in spark.sql("select * from runs").collect()] == [("k", 0.0, 2.0, 2)]
