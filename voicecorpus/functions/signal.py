"""Frame, level and boundary functions.  Columns over ARRAY<DOUBLE> where built-in functions
express them; numpy over Arrow batches for spectra, filters and resampling."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def frames(samples: Column, frame_len: int) -> Column:
    """RMS of each whole frame (of one shorter frame, if there is no whole one)."""
    n = F.greatest(F.lit(1), F.floor(F.size(samples) / frame_len)).cast("int")
    square = lambda part: F.aggregate(part, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) / F.greatest(F.size(part), F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.sqrt(square(F.slice(samples, i * frame_len + 1, F.lit(frame_len))) + 1e-12))


def quantile(values: Column, q: float) -> Column:
    """Linear-interpolated quantile of an array; null if it is empty."""
    s = F.array_sort(values)
    at = (F.size(s) - 1) * F.lit(q)
    lo = F.floor(at).cast("int")
    a, b = F.try_element_at(s, lo + 1), F.try_element_at(s, F.least(lo + 2, F.size(s)))
    return F.when(F.size(s) > 0, a + (b - a) * (at - lo))


def silence_threshold(rms: Column, rel: float = 0.15) -> Column:
    return F.greatest(quantile(rms, 0.95) * rel, F.lit(1e-4))


def _mean(values: Column, f=lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + f(x)) / F.nullif(F.size(values), F.lit(0))


def silence_ratio(rms: Column, threshold: Column) -> Column:
    return F.size(F.filter(rms, lambda x: x < threshold)) / F.size(rms)


def snr_db(rms: Column, threshold: Column) -> Column:
    """Ten times the log of speech power over noise power; 0 without speech."""
    loud = _mean(F.filter(rms, lambda x: x >= threshold), lambda x: x * x)
    soft = _mean(F.filter(rms, lambda x: x < threshold), lambda x: x * x)
    return F.when(loud.isNull(), 0.0).otherwise(10 * F.log10(loud / F.greatest(F.coalesce(soft, F.lit(1e-8)), F.lit(1e-8))))


def peak(samples: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double")))), F.lit(0.0))


def to_mono(*channels: Column) -> Column:
    """The mean of any number of channels (arrays of one length), sample by sample."""
    whole = lambda x, i: sum((F.get(c, i).cast("double") for c in channels[1:]), x.cast("double")) / len(channels)
    return F.transform(channels[0], whole)


def gain(lufs: Column, target: float, peak_: Column, cap: float = 0.99) -> Column:
    """Factor to the target loudness that keeps the peak at ``cap``; 1 if it is unmeasured or not finite."""
    g = F.pow(F.lit(10.0), (F.lit(target) - lufs) / 20)
    return F.when(lufs.isNull() | F.isnan(lufs.cast("double")) | (F.abs(lufs.cast("double")) == float("inf")), 1.0).when(peak_ * g > cap, cap / peak_).otherwise(g)


def _islands(rms: Column, threshold: Column, lo: Column, hi: Column) -> Column:
    """(first, length) of runs of silent frames in [lo, hi), in order."""
    idx = F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<int>"))
    empty = F.array().cast("array<struct<a:int,n:int>>")

    def add(runs: Column, i: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        silent = F.element_at(rms, i + 1) < threshold
        joins = last.isNotNull() & (last["a"] + last["n"] == i)
        longer = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(last["a"].alias("a"), (last["n"] + 1).alias("n"))))
        return F.when(~silent, runs).when(joins, longer).otherwise(F.concat(runs, F.array(F.struct(i.alias("a"), F.lit(1).alias("n")))))

    return F.aggregate(idx, empty, add)


def _need(pause: float, frame_len: int | Column, sr: int | Column):
    """Whole frames of a pause, one at least."""
    if isinstance(sr, Column):
        return F.greatest(F.lit(1), (pause * sr / frame_len).cast("int"))
    return max(1, int(pause * sr / frame_len))


def _double(n: int | Column):
    return n.cast("double") if isinstance(n, Column) else float(n)


def snap_end(rms: Column, frame_len: int | Column, sr: int | Column, threshold: Column, t: Column, back: float = 0.24, fwd: float = 0.8, pause: float = 0.3) -> Column:
    """Where the first pause after ``t - back`` begins; ``t`` if silence is already there, or none is found."""
    lo = F.greatest(F.lit(0), ((t - back) * sr / frame_len).cast("int"))
    hi = F.least(F.size(rms), ((t + fwd) * sr / frame_len).cast("int") + 1)
    need = _need(pause, frame_len, sr)
    first = F.try_element_at(F.filter(_islands(rms, threshold, lo, hi), lambda r: r["n"] >= need), F.lit(1))
    return F.when(first.isNull() | (first["a"] == lo), t).otherwise(first["a"] * _double(frame_len) / sr)


def snap_start(rms: Column, frame_len: int | Column, sr: int | Column, threshold: Column, t: Column, back: float = 0.8, fwd: float = 0.24, pause: float = 0.3) -> Column:
    """The mirror of ``snap_end``: where the last pause before ``t + fwd`` ends."""
    hi = F.least(F.size(rms) - 1, ((t + fwd) * sr / frame_len).cast("int"))
    lo = F.greatest(F.lit(0), ((t - back) * sr / frame_len).cast("int"))
    need = _need(pause, frame_len, sr)
    last = F.try_element_at(F.filter(_islands(rms, threshold, lo, hi + 1), lambda r: r["n"] >= need), F.lit(-1))
    end = last["a"] + last["n"] - 1
    return F.when(last.isNull() | (end == hi), t).otherwise((end + 1) * _double(frame_len) / sr)


def _around(regions: Column, t: Column) -> tuple[Column, Column]:
    """The last region that begins by ``t``, and the first after."""
    return F.try_element_at(F.filter(regions, lambda r: r["start"] <= t), F.lit(-1)), F.try_element_at(F.filter(regions, lambda r: r["start"] > t), F.lit(1))


def snapped_end(start: Column, end: Column, t: Column, back: float = 0.24, fwd: float = 0.8) -> Column:
    """Where ``t``, an end, snaps to, given the last region (null: none) that begins by it."""
    inside = F.when(end <= t + fwd, end).otherwise(t)
    return F.when(start.isNull(), t).when(t <= end, inside).when(end >= t - back, end).otherwise(t)


def snapped_start(start: Column, end: Column, after: Column, t: Column, back: float = 0.8, fwd: float = 0.24) -> Column:
    """The same for a start, given also where the next region begins."""
    gap = F.when(after <= t + fwd, after).otherwise(t)
    return F.when(start.isNotNull() & (t <= end), F.when(start >= t - back, start).otherwise(t)).otherwise(gap)


def snap_end_regions(regions: Column, t: Column, back: float = 0.24, fwd: float = 0.8) -> Column:
    at, _ = _around(regions, t)
    return snapped_end(at["start"], at["end"], t, back, fwd)


def snap_start_regions(regions: Column, t: Column, back: float = 0.8, fwd: float = 0.24) -> Column:
    at, after = _around(regions, t)
    return snapped_start(at["start"], at["end"], after["start"], t, back, fwd)


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation on an even grid."""
    if rate == to or not len(x):
        return np.asarray(x, np.float32)
    n = int(round(len(x) / rate * to))
    at = np.arange(n) * (len(x) / max(n, 1))
    return np.interp(at, np.arange(len(x)), x).astype(np.float32)


def resampled(rate: int, to: int):
    @F.pandas_udf("array<float>")
    def f(s: pd.Series) -> pd.Series:
        return s.map(lambda x: resample(np.asarray(x, np.float64), rate, to), na_action="ignore")

    return f


def frame_levels(x: np.ndarray, size: int) -> np.ndarray:
    n = len(x) // size
    return np.sqrt((x[: n * size].reshape(n, size).astype(np.float64) ** 2).mean(1) + 1e-12) if n else np.zeros(0)


def edge_noise(x: np.ndarray, sr: int, frame_ms: int = 10, strong: float = 0.30, weak: float = 0.05, max_hz: float = 900.0, min_gap_ms: float = 0.0) -> float:
    """Longest low-pitched weak noise (ms), set off by silence, before the first strong frame."""
    size = max(1, int(sr * frame_ms / 1000))
    rms = frame_levels(np.asarray(x, np.float64), size)
    if len(rms) < 2:
        return 0.0
    top = np.quantile(rms, 0.95)
    loud = np.flatnonzero(rms >= strong * top)
    if not len(loud):
        return 0.0
    first, floor = int(loud[0]), max(weak * top, 1e-4)
    gap = int(round(min_gap_ms / frame_ms))
    on = np.concatenate(([False], rms[:first] >= floor, [False]))
    edges = np.flatnonzero(on[1:] != on[:-1])
    best = 0.0
    hz = np.fft.rfftfreq(size, 1 / sr)
    for a, f in edges.reshape(-1, 2):
        if a == 0 or first - f < gap or (rms[f : f + gap] >= floor).any():
            continue
        spec = np.abs(np.fft.rfft(np.asarray(x[a * size : f * size], np.float64).reshape(-1, size) * np.hanning(size), axis=1))
        total = spec.sum(1)
        centre = np.where(total > 0, spec @ hz / np.maximum(total, 1e-300), 0.0)
        if np.median(centre) < max_hz:
            best = max(best, float((f - a) * frame_ms))
    return best


def _filtered(b: np.ndarray, a: np.ndarray, x: np.ndarray, block: int = 256) -> np.ndarray:
    """``x`` through a second-order filter (a: the two coefficients after 1), a block at a time: within
    blocks by one matrix product, from block to block by the two values of the filter's state."""
    n = -(-len(x) // block)
    h = np.zeros(block)  # response to one sample
    z = np.zeros(2)
    ring = np.zeros((2, block))  # response to each value of the state
    for i in range(block):
        v = float(i == 0)
        h[i] = b[0] * v + z[0]
        z = np.array([b[1] * v - a[0] * h[i] + z[1], b[2] * v - a[1] * h[i]])
    for k in range(2):
        z = np.eye(2)[k]
        for i in range(block):
            ring[k, i] = z[0]
            z = np.array([-a[0] * ring[k, i] + z[1], -a[1] * ring[k, i]])
    at = np.arange(block)[:, None] - np.arange(block)[None]
    toeplitz = np.where(at >= 0, h[np.maximum(at, 0)], 0.0)
    padded = np.zeros(n * block)
    padded[: len(x)] = x
    rows = padded.reshape(n, block)
    out = rows @ toeplitz.T
    z = np.zeros(2)
    for i in range(n):
        out[i] += z @ ring
        # the state after a block, from its last two samples in and out
        y, u = out[i, -2:], rows[i, -2:]
        z = np.array([b[1] * u[1] - a[0] * y[1] + b[2] * u[0] - a[1] * y[0], b[2] * u[1] - a[1] * y[1]])
    return out.ravel()[: len(x)]


def k_weighting(sr: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(b, a without its first 1) of the two filters of BS.1770 at a rate: a high shelf, a high pass."""
    out = []
    for gain_db, q, f0, kind in ((3.999843853973347, 0.7071752369554196, 1681.974450955533, "shelf"), (0.0, 0.5003270373238773, 38.13547087602444, "high")):
        k = math.tan(math.pi * f0 / sr)
        a0 = 1 + k / q + k * k
        a = np.array([2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0])
        b = np.array([1.0, -2.0, 1.0])
        if kind == "shelf":
            vh = 10 ** (gain_db / 20)
            vb = vh**0.4996667741545416
            b = np.array([vh + vb * k / q + k * k, 2 * (k * k - vh), vh - vb * k / q + k * k]) / a0
        out.append((b, a))
    return out


def loudness(x: np.ndarray, sr: int) -> float | None:
    """Integrated loudness (LUFS) by ITU-R BS.1770: K-weighting, 400 ms blocks, both gates."""
    x = np.asarray(x, np.float64)
    size, hop = int(0.4 * sr), int(0.1 * sr)
    if len(x) < size or not size:
        return None
    for b, a in k_weighting(sr):
        x = _filtered(b, a, x)
    energy = np.concatenate(([0.0], np.cumsum(x * x)))
    at = np.arange(0, len(x) - size + 1, hop)
    power = (energy[at + size] - energy[at]) / size
    level = -0.691 + 10 * np.log10(np.maximum(power, 1e-12))
    kept = power[level > -70]
    if not len(kept):
        return None
    gate = -0.691 + 10 * math.log10(kept.mean()) - 10
    kept = power[(level > -70) & (level > gate)]
    return float(-0.691 + 10 * math.log10(kept.mean())) if len(kept) else None


def loudness_of(sr: int):
    @F.pandas_udf("double")
    def f(s: pd.Series) -> pd.Series:
        return s.map(lambda x: loudness(np.asarray(x), sr), na_action="ignore").astype("float64")

    return f


def edge_noise_of(sr: int, reverse: bool = False, **kw):
    @F.pandas_udf("double")
    def f(s: pd.Series) -> pd.Series:
        return s.map(lambda x: edge_noise(np.asarray(x)[:: -1 if reverse else 1], sr, **kw), na_action="ignore").astype("float64")

    return f


def speech_regions(x: np.ndarray, sr: int, min_silence: float = 0.3, pad: float = 0.03) -> list[tuple]:
    """Default region detector: frames above the silence threshold, short gaps closed."""
    size = max(1, int(sr * 0.02))
    rms = frame_levels(np.asarray(x, np.float64), size)
    if not len(rms):
        return []
    on = np.concatenate(([False], rms >= max(np.quantile(rms, 0.95) * 0.15, 1e-4), [False]))
    out: list[list[float]] = []
    for a, f in np.flatnonzero(on[1:] != on[:-1]).reshape(-1, 2) * size / sr:
        if out and a - out[-1][1] < min_silence:
            out[-1][1] = f
        else:
            out.append([a, f])
    return [(max(0.0, a - pad), min(len(x) / sr, f + pad)) for a, f in out]
