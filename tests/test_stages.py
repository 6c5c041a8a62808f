"""The stages end to end on synthetic sound."""

import json
import math
import struct

import numpy as np
import pytest

from voicecorpus import config, providers, schemas
from voicecorpus.functions import signal as S
from voicecorpus.plans import pipeline
from voicecorpus.sources import audio, records

SR = 22050


def bursts(sr=SR):
    """Five seconds, with tones from 0.5 to 2.0 and from 3.0 to 4.5."""
    t = np.arange(5 * sr) / sr
    x = np.zeros(len(t))
    for hz, a, b in ((220.0, 0.5, 2.0), (330.0, 3.0, 4.5)):
        on = (t >= a) & (t < b)
        x[on] = np.sin(t[on] * hz * 2 * np.pi) * 0.3
    return x


def settings(top, **over):
    data = {"paths": {k: str(top / k) for k in ("raw", "work", "dataset")}, "quality": {"reasr_check": False}, "segment": {"vad": "energy"}, "export": {"loudness_normalize": False}}
    return config.Config(config.deep_merge(config.deep_merge(config.DEFAULTS, data), over))


def book(spark, cfg, top, name, spans, chapter="ch01"):
    folder = top / "raw" / name / "audio"
    folder.mkdir(parents=True)
    (folder / f"{chapter}.wav").write_bytes(audio.encode(bursts(), SR))
    rows = [(name, chapter, f"{name}_s{i:05d}", text, text.lower(), a, b, 1.0, ["x"]) for i, (text, a, b) in enumerate(spans)]
    records.write_by_book(spark.createDataFrame(rows, schemas.SEGMENT), cfg.stage_path("align"))
    return pipeline.run(spark, cfg, stage="ingest", book=name)


TWO = [("První | věta.", 0.5, 2.0), ("Druhá věta.", 3.0, 4.5)]


def checked(spark, cfg):
    return {r.clip_id: r for r in records.read_jsonl(spark, cfg.stage_path("quality"), schemas.CHECKED).collect()}


def test_from_sound_to_dataset(spark, tmp_path):
    cfg = settings(tmp_path, export={"format": "ljspeech"})
    assert book(spark, cfg, tmp_path, "synt", TWO) == {"ingest": 1}
    assert pipeline.run(spark, cfg, from_stage="segment", book="synt") == {"segment": 2, "quality": 2, "export": 1}
    q = checked(spark, cfg)
    assert set(q) == {"ch01_0000", "ch01_0001"} and all(r.duration > 1 and r.status in ("pass", "review") for r in q.values())
    assert all(not {"duration", "edge_noise"} & set(r.flags) and 0.29 < r.peak < 0.31 and r.cer is None for r in q.values())
    there = tmp_path / "dataset" / "synt"
    lines = (there / "metadata.csv").read_text().splitlines()
    stats = json.loads((there / "dataset_stats.json").read_text())
    n = sum(r.status == "pass" for r in q.values())
    assert n == 2 == stats["clips"] and lines == ["ch01_0000|První   věta.|první   věta.", "ch01_0001|Druhá věta.|druhá věta."]
    parts = [(there / f"metadata_{s}.csv").read_text().splitlines() for s in ("train", "val")]
    assert sorted(parts[0] + parts[1]) == sorted(lines) and len(parts[1]) == 1 == stats["val_clips"]
    assert stats["speakers"] == ["synt"] and stats["sample_rate"] == 22050 and stats["char_inventory"] == "".join(sorted(set("První | věta.Druhá věta.")))
    assert stats["total_hours"] == round(sum(r.duration for r in q.values()) / 3600, 3)
    assert "22050" in (there / "PIPER.md").read_text()
    cfg = settings(tmp_path, export={"format": "piper", "sample_rate": 16000})
    assert pipeline.run(spark, cfg, stage="export", force=True) == {"export": 1}
    assert (there / "metadata.csv").read_text().splitlines()[1] == "ch01_0001.wav|Druhá věta."
    x, sr = audio.decode((there / "wavs" / "ch01_0001.wav").read_bytes())
    assert sr == 16000 and len(x) / sr == pytest.approx(q["ch01_0001"].duration, abs=0.002)
    with pytest.raises(ValueError):
        pipeline.run(spark, settings(tmp_path, export={"format": "x"}), stage="export", force=True)


def test_loudness_is_brought_to_the_target(spark, tmp_path):
    cfg = settings(tmp_path)
    book(spark, cfg, tmp_path, "synt", TWO[:1])
    pipeline.run(spark, cfg, from_stage="segment")
    wav = tmp_path / "dataset/synt/wavs/ch01_0000.wav"
    level = lambda: 20 * math.log10(np.sqrt((audio.decode(wav.read_bytes())[0].astype(float) ** 2).mean()))
    plain = level()
    pipeline.run(spark, settings(tmp_path, export={"loudness_normalize": True}), stage="export", force=True)
    assert level() < plain and abs(level() + 23) < 3.5
    assert S.loudness(*audio.decode(wav.read_bytes())) == pytest.approx(-23, abs=0.05)


def test_verdicts_outlive_a_further_run(spark, tmp_path):
    cfg = settings(tmp_path)
    book(spark, cfg, tmp_path, "synt", TWO)
    book(spark, cfg, tmp_path, "other", TWO)  # clips of the same names
    pipeline.run(spark, cfg, stage="segment")
    pipeline.run(spark, cfg, stage="quality")
    there = tmp_path / "work/review/synt"
    there.mkdir(parents=True)
    (there / "verdicts.csv").write_text("clip_id,verdict,flags\nch01_0001,approve,\nch01_0001,reject,\nzz,reject,\n")
    assert pipeline.apply_book_review(spark, cfg, "other") is None
    assert pipeline.apply_book_review(spark, cfg, "synt") == {"approved": 0, "rejected": 1, "stale": 1}
    for again in (False, True):
        if again:
            assert pipeline.run(spark, cfg, stage="quality", force=True) == {"quality": 4}
        got = {(r.book_id, r.clip_id): (r.status, r.verdict) for r in records.read_jsonl(spark, cfg.stage_path("quality"), schemas.CHECKED).collect()}
        assert len(got) == 4 and got["synt", "ch01_0001"] == ("reject", "reject") and got["other", "ch01_0001"] == ("pass", None)
    pipeline.run(spark, cfg, stage="export")
    assert "ch01_0001" not in (tmp_path / "dataset/synt/metadata.csv").read_text() and "ch01_0001" in (tmp_path / "dataset/other/metadata.csv").read_text()


def test_flagged_clips_are_reported(spark, tmp_path):
    cfg = settings(tmp_path)
    book(spark, cfg, tmp_path, "synt", [("krátké", 0.6, 0.8)])
    pipeline.run(spark, cfg, stage="segment")
    pipeline.run(spark, settings(tmp_path, segment={"min_duration": 3.0}), stage="quality")
    (r,) = spark.read.option("header", True).csv(f"{cfg.stage_path('quality')}-flagged").collect()
    assert (r.clip_id, r.status, r.flags, r.book_id) == ("ch01_0000", "reject", "duration", "synt")
    assert pipeline.run(spark, cfg, stage="export") == {"export": 0} and not (tmp_path / "dataset").exists()


def test_books_are_done_one_by_one(spark, tmp_path):
    cfg = settings(tmp_path)
    book(spark, cfg, tmp_path, "one", TWO)
    assert pipeline.run(spark, cfg, stage="segment", book="one") == {"segment": 2}
    book(spark, cfg, tmp_path, "two", TWO[:1])
    assert pipeline.run(spark, cfg, stage="segment") == {"segment": 1}  # the other is done
    assert pipeline.run(spark, cfg, stage="segment") == {"segment": None}
    assert pipeline.run(spark, cfg, stage="segment", force=True) == {"segment": 3}
    (tmp_path / "raw/three").mkdir()
    for stage in ("transcribe", "align", "segment", "quality", "export", "text_prep"):
        with pytest.raises(FileNotFoundError):
            pipeline.run(spark, cfg, stage=stage, book="three")
    assert records.folders(spark, cfg.require("paths.raw")) == ["one", "three", "two"]


class Stub:
    made = 0

    def transcribe(self, samples, sr):
        assert sr == 16000
        return {"text": [" první", " věta druhá věta "], "words": [{"start": 0.50001, "end": 1.2, "word": " První ", "prob": 0.98765}, {"start": 1.2, "end": 2.0, "word": "věta", "prob": None}, {"start": 3.0, "end": 3.7, "word": "druhá", "prob": 1.0}, {"start": 3.7, "end": 4.5, "word": "věta", "prob": 1.0}]}


@pytest.mark.parametrize("backend", ["stub", "precomputed"])
def test_from_books_to_datasets(spark, tmp_path, backend):
    cfg = settings(tmp_path, asr={"backend": backend})
    here = tmp_path / "raw/kniha"
    (here / "audio").mkdir(parents=True)
    (here / "audio/01.wav").write_bytes(audio.encode(bursts(), SR))
    (here / "book.txt").write_text("První věta. Druhá věta.")
    words = Stub().transcribe(None, 16000)["words"]
    (here / "transcript.jsonl").write_text(json.dumps({"chapter_id": "01", "asr_text": "první věta druhá věta", "words": words}) + "\n")
    if backend == "stub":
        providers.RECOGNISERS["stub"] = Stub
    got = pipeline.run(spark, cfg)
    assert got == {"ingest": 1, "text_prep": 2, "transcribe": 1, "align": 2, "segment": 2, "quality": 2, "export": 1}
    for stage, key in (("text_prep", "sent_id"), ("align", "start"), ("quality", "clip_id")):  # a file each, in order
        (f,) = (tmp_path / "work" / config.STAGE_FOLDERS[stage] / "book_id=kniha").glob("part*")
        found = [json.loads(x)[key] for x in f.read_text().splitlines()]
        assert len(found) == 2 and found == sorted(found)
    heard = records.read_jsonl(spark, cfg.stage_path("transcribe"), schemas.TRANSCRIPT).first()
    assert heard.asr_text == "první věta druhá věta" and len(heard.words) == 4
    if backend == "stub":
        assert tuple(heard.words[0]) == (0.5, 1.2, "První", 0.988) and heard.words[1].prob == 0.0
        # each clip heard anew: twice the words of its label
        over = {"asr": {"backend": "once"}, "quality": {"reasr_check": True, "reasr_reuse": True}, "export": {"loudness_normalize": False}}
        Once.calls = str(tmp_path / "calls")
        providers.RECOGNISERS["once"] = lambda: Once(str(tmp_path / "calls"))
        for n in (2, 2):  # the second run takes what the first heard
            assert pipeline.run(spark, settings(tmp_path, **over), stage="quality", force=True) == {"quality": 2}
            q = checked(spark, cfg)
            assert {k: (r.asr_text, r.cer, r.status) for k, r in q.items()} == {"01_0000": ("první věta", 0.0, "pass"), "01_0001": ("první věta", 0.4, "reject")}
            assert len((tmp_path / "calls").read_text()) == n


class Once:
    def __init__(self, path):
        self.path = path

    def transcribe(self, samples, sr):
        with open(self.path, "a") as f:
            f.write("x")
        return {"text": "první věta", "words": []}


def test_a_recogniser_that_is_not_there(spark, tmp_path):
    cfg = settings(tmp_path)
    book(spark, cfg, tmp_path, "synt", TWO)
    with pytest.raises(Exception, match="faster-whisper is not installed"):
        pipeline.run(spark, cfg, stage="transcribe")
    (tmp_path / "raw/synt/audio/02.opus").write_bytes(b"OggS")
    with pytest.raises(Exception, match="no decoder for .opus"):
        pipeline.run(spark, cfg, stage="ingest", force=True)


def test_strategies_are_compared(spark, tmp_path):
    cfg = settings(tmp_path)
    book(spark, cfg, tmp_path, "synt", TWO)
    loose = [("synt", "ch01", "a", "t", "t", 0.3, 2.3, 0.8, ["x"]), ("synt", "ch01", "b", "t", "t", 2.8, 4.6, None, ["x"]), ("synt", "none", "c", "t", "t", 0.0, 1.0, 1.0, ["x"])]
    records.write_by_book(spark.createDataFrame(loose, schemas.SEGMENT), str(tmp_path / "loose"))
    got = {r.strategy: r for r in pipeline.compare(spark, cfg, "synt", {"tight": cfg.stage_path("align"), "loose": str(tmp_path / "loose")}).collect()}
    t, w = got["tight"], got["loose"]
    assert (t.segments, t.audio_seconds, t.retained_pct, t.mean_score, t.lead_silence_mean, t.trail_silence_mean) == (2, 3.0, 60.0, 1.0, 0.0, 0.0)
    assert (w.segments, w.mean_score) == (3, 0.6) and w.lead_silence_mean == pytest.approx(0.2, abs=0.021) and w.trail_silence_mean == pytest.approx(0.2, abs=0.03)


def test_wav_kinds():
    x = np.sin(np.arange(4001) / 9) * 0.7
    for kind, codec, tolerance in (("s16", "pcm_s16le", 1e-4), ("s24", "pcm_s24le", 1e-6), ("f32", "pcm_f32le", 1e-7), ("any", "pcm_s16le", 1e-4)):
        content = audio.encode(x, 8000, kind, 2)
        y, sr = audio.decode(content)
        assert sr == 8000 and np.abs(y - x).max() < tolerance and audio.probe(content) == {"duration": 4001 / 8000, "codec": codec, "sample_rate": 8000, "channels": 2}
    wav = lambda tag, bits, raw, extra=b"": b"RIFF" + struct.pack("<I", 0) + b"WAVE" + b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<I", 16 + len(extra)) + struct.pack("<HHIIHH", tag, 1, 100, 100, 1, bits) + extra + b"data" + struct.pack("<I", 9999) + raw
    assert audio.decode(wav(1, 8, bytes([0, 128, 255])))[0].tolist() == pytest.approx([-1, 0, 127 / 128])
    assert audio.decode(wav(3, 64, np.array([0.25, -0.5]).tobytes()))[0].tolist() == [0.25, -0.5]
    assert audio.decode(wav(1, 32, np.array([1 << 30], "<i4").tobytes()))[0].tolist() == [0.5]
    assert audio.decode(wav(0xFFFE, 16, np.array([16384], "<i2").tobytes() + b"x", struct.pack("<HHI", 22, 16, 0) + struct.pack("<H", 1) + b"\0" * 14))[0].tolist() == [0.5]
    for bad in (b"", b"none", wav(7, 8, b"abc"), audio.encode(x, 8000)[:30]):
        assert audio.probe(bad)["codec"] is None
        with pytest.raises(audio.NotReadable):
            audio.decode(bad)


def test_block_filter_is_the_recursion():
    rng = np.random.default_rng(3)
    b, a = np.array([1.5, -2.6, 1.2]), np.array([-1.69, 0.73])
    for n in (1, 255, 256, 257, 3000):
        x = rng.normal(0, 1, n)
        want, z = [], [0.0, 0.0]
        for v in x:
            y = b[0] * v + z[0]
            z = [b[1] * v - a[0] * y + z[1], b[2] * v - a[1] * y]
            want.append(y)
        assert np.allclose(S._filtered(b, a, x), want)


def test_mean_of_channels(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([1.0, 2.0], [3.0, 6.0], [2.0, 1.0])], "a array<double>, b array<double>, c array<double>")
    r = df.select(S.to_mono(F.col("a")).alias("x"), S.to_mono(F.col("a"), F.col("b")).alias("y"), S.to_mono(F.col("a"), F.col("b"), F.col("c")).alias("z")).first()
    assert r.x == [1.0, 2.0] and r.y == [2.0, 4.0] and r.z == [2.0, 3.0]
    g = spark.createDataFrame([(None,), (float("nan"),), (float("-inf"),), (-33.0,)], "l double").select(S.gain(F.col("l"), -23.0, F.lit(0.1)).alias("g")).collect()
    assert [round(r.g, 3) for r in g] == [1.0, 1.0, 1.0, 3.162]


def test_voices(spark):
    v = spark.createDataFrame([("a", "cs-CZ"), ("b", "en-GB"), ("c", "sk-SK")], "ShortName string, Locale string")
    assert [r.ShortName for r in providers.voices(v).collect()] == ["a"]
