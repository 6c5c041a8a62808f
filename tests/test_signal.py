import numpy as np
import pytest
from pyspark.sql import functions as F

from voicecorpus.functions import signal as S


def tones(spans, sr):
    return np.concatenate([amp * np.sin(2 * np.pi * hz * np.arange(int(sec * sr)) / sr) for sec, amp, hz in spans])


def series(*spans):
    return [v for n, v in spans for _ in range(int(n * 50))]


@pytest.mark.parametrize(
    "rms,t,end",
    [
        (series((1.0, 1), (0.16, 0), (0.14, 1), (0.7, 0)), 1.0, 1.30),
        (series((1.1, 1), (0.9, 0)), 1.0, 1.1),
        (series((3.0, 1)), 1.5, 1.5),
        (series((0.9, 1), (1.1, 0)), 1.0, 0.9),
    ],
)
def test_snap_end(spark, rms, t, end):
    df = spark.createDataFrame([([float(x) for x in rms], t)], "rms array<double>, t double")
    assert df.select(S.snap_end(F.col("rms"), 20, 1000, F.lit(0.5), F.col("t"))).first()[0] == pytest.approx(end, abs=0.021)


def plain_snap_end(rms, t, thr=0.5, need=15):
    lo, hi = max(0, int((t - 0.24) * 50)), min(len(rms), int((t + 0.8) * 50) + 1)
    run = None
    for i in range(lo, hi):
        if rms[i] < thr:
            run = i if run is None else run
            if i - run + 1 >= need:
                return t if run == lo else run / 50
        else:
            run = None
    return t


def test_snap_end_matches_a_scan(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(300):
        rms = np.repeat(rng.integers(0, 2, 12), rng.integers(1, 25, 12)).astype(float).tolist()
        rows.append((rms, float(rng.uniform(0, len(rms) / 50))))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, rms array<double>, t double")
    got = [r.s for r in df.select("i", S.snap_end(F.col("rms"), 20, 1000, F.lit(0.5), F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == pytest.approx([plain_snap_end(*r) for r in rows])


def test_snap_start(spark):
    rms = series((0.3, 1), (0.4, 0), (0.2, 1), (0.1, 0), (1.0, 1))
    df = spark.createDataFrame([([float(x) for x in rms],)], "rms array<double>")
    assert df.select(S.snap_start(F.col("rms"), 20, 1000, F.lit(0.5), F.lit(1.0))).first()[0] == pytest.approx(0.70, abs=0.021)


def test_regions(spark):
    regions = list(zip((0.5, 3.0, 10.0), (2.0, 5.0, 20.0), strict=True))
    ends = {1.8: 2.0, 11.0: 11.0, 2.1: 2.0, 2.6: 2.6, 0.2: 0.2}
    starts = {3.4: 3.0, 15.0: 15.0, 2.8: 3.0, 2.2: 2.2}
    df = spark.createDataFrame([(regions, t) for t in [*ends, *starts]] + [([], 1.0)], "regions array<struct<start:double,end:double>>, t double")
    got = df.select("t", S.snap_end_regions(F.col("regions"), F.col("t")).alias("e"), S.snap_start_regions(F.col("regions"), F.col("t")).alias("s")).collect()
    for r in got[:-1]:
        assert r.e == ends.get(r.t, r.e) and r.s == starts.get(r.t, r.s)
    assert got[-1].e == got[-1].s == 1.0


def test_frames_and_levels(spark):
    rng = np.random.default_rng(2)
    xs = [rng.normal(0, 1, n).tolist() for n in (64, 37, 5)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x array<double>").withColumn("rms", S.frames(F.col("x"), 8))
    df = df.withColumn("thr", S.silence_threshold(F.col("rms")))
    for r in df.select("i", "rms", "thr", S.snr_db(F.col("rms"), F.col("thr")).alias("snr"), S.peak(F.col("x")).alias("peak")).collect():
        x = np.array(xs[r.i])
        want = S.frame_levels(x, 8) if len(x) >= 8 else np.sqrt([(x**2).mean() + 1e-12])
        assert np.allclose(r.rms, want) and r.thr == pytest.approx(max(np.quantile(want, 0.95) * 0.15, 1e-4)) and r.peak == pytest.approx(np.abs(x).max())


def test_edge_noise():
    sr = 16000
    lead = tones([(0.3, 0.0, 1), (0.06, 0.06, 150), (0.24, 0.0, 1), (1.0, 0.5, 1500)], sr)
    assert S.edge_noise(lead, sr) >= 50
    assert S.edge_noise(tones([(1.0, 0.5, 1500)], sr), sr) == 0
    assert S.edge_noise(np.zeros(sr), sr) == 0 and S.edge_noise(np.zeros(10), sr) == 0
    assert S.edge_noise(lead, sr, min_gap_ms=300) == 0


def test_loudness_resample_and_gain(spark):
    sr = 48000
    assert S.loudness(tones([(5, 1.0, 997)], sr), sr) == pytest.approx(-3.01, abs=0.05)  # the standard's own case
    assert S.loudness(np.zeros(sr), sr) is None and S.loudness(np.zeros(10), sr) is None
    x = np.arange(100, dtype=float)
    y = S.resample(x, 100, 50)
    assert len(y) == 50 and np.allclose(y, np.arange(0, 100, 2)) and S.resample(x, 7, 7).tolist() == x.tolist()
    df = spark.createDataFrame([(-23.0, 0.5), (-43.0, 0.5), (None, 0.5)], "l double, p double")
    assert [round(r[0], 6) for r in df.select(S.gain(F.col("l"), -23.0, F.col("p"))).collect()] == [1.0, 1.98, 1.0]


def test_speech_regions():
    sr = 16000
    got = S.speech_regions(tones([(0.5, 0, 1), (1.0, 0.5, 300), (0.1, 0, 1), (0.4, 0.5, 300), (1.0, 0, 1)], sr), sr)
    assert len(got) == 1 and got[0] == pytest.approx((0.47, 2.03), abs=0.03)
