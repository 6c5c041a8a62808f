import numpy as np
import pytest

from voicecorpus import config, schemas
from voicecorpus.plans import pipeline
from voicecorpus.sources import audio, records


def tone(*spans, sr=16000):
    return np.concatenate([a * np.sin(np.arange(int(s * sr)) * 0.5) for s, a in spans])


@pytest.mark.parametrize("vad", ["silero", "energy"])
def test_segment_snaps_to_silence_and_cuts_wavs(spark, tmp_path, vad):
    (tmp_path / "raw/bk/audio").mkdir(parents=True)
    # speech from 0.5 to 2.1 s and from 3.0 to 4.5 s; the words end early and begin late
    x = tone((0.5, 0.0), (1.6, 0.5), (0.9, 0.0), (1.5, 0.5), (0.5, 0.0))
    (tmp_path / "raw/bk/audio/01.wav").write_bytes(audio.encode(x, 16000))
    cfg = config.Config(config.deep_merge(config.DEFAULTS, {"paths": {"raw": str(tmp_path / "raw"), "work": str(tmp_path / "work")}, "segment": {"vad": vad}}))
    pipeline.run(spark, cfg, stage="ingest")
    segs = [("bk", "01", "s0", "a", "a", 0.7, 1.9, 1.0, ["a"]), ("bk", "01", "s1", "b", "b", 3.2, 4.3, 1.0, ["b"])]
    records.write_by_book(spark.createDataFrame(segs, schemas.SEGMENT), cfg.stage_path("align"))
    assert pipeline.run(spark, cfg, stage="segment") == {"segment": 2}
    got = records.read_jsonl(spark, cfg.stage_path("segment"), schemas.CLIP).orderBy("clip_id").collect()
    assert [r.clip_id for r in got] == ["01_0000", "01_0001"] and {r.speaker_id for r in got} == {"bk"}
    for r, (a, b) in zip(got, [(0.4, 2.2), (2.9, 4.6)], strict=True):
        assert r.start == pytest.approx(a, abs=0.051) and r.end == pytest.approx(b, abs=0.051)
        with open(r.wav, "rb") as f:
            y, sr = audio.decode(f.read())
        assert sr == 22050 and len(y) / sr == pytest.approx(r.duration, abs=0.002)
        assert abs(y).max() > 0.4 and abs(y[:400]).max() < 0.01 and abs(y[-400:]).max() < 0.01


def test_segment_refuses_an_unknown_detector(spark):
    with pytest.raises(ValueError):
        pipeline.segment(spark, config.Config(config.deep_merge(config.DEFAULTS, {"segment": {"vad": "other"}})), ["bk"])
