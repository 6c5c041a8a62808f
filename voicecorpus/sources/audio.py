"""WAV in and out, in Arrow batches; other codecs through a provider."""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import signal as S
from ..functions.signal import frame_levels, resample, speech_regions

_KINDS = {(1, 8): "pcm_u8", (1, 16): "pcm_s16le", (1, 24): "pcm_s24le", (1, 32): "pcm_s32le", (3, 32): "pcm_f32le", (3, 64): "pcm_f64le"}


class NotReadable(ValueError):
    """Content that is no WAV of whole or floating samples."""


def _parse(content: bytes) -> tuple[str, int, int, bytes]:
    """(codec, channels, rate, sample bytes) of a WAV: its chunks one after another; sizes past the
    end (of a stream that was cut) end there."""
    if len(content) < 12 or content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise NotReadable("no WAV")
    at, kind = 12, None
    while at + 8 <= len(content):
        name, size = content[at : at + 4], struct.unpack_from("<I", content, at + 4)[0]
        body = at + 8
        if name == b"fmt " and size >= 16 and body + 16 <= len(content):
            tag, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", content, body)
            if tag == 0xFFFE and size >= 26:  # the real tag begins the sub-format
                tag = struct.unpack_from("<H", content, body + 24)[0]
            kind = (_KINDS.get((tag, bits)), channels, rate, bits)
        elif name == b"data" and kind:
            codec, channels, rate, bits = kind
            if not codec or not channels or not rate:
                break
            raw = content[body : body + size]
            step = channels * bits // 8
            return codec, channels, rate, raw[: len(raw) // step * step]
        at = body + size + size % 2
    raise NotReadable("no samples of a known kind")


def probe(content: bytes) -> dict:
    """duration, codec, sample_rate and channels; zeros and None if it is no WAV that ``decode`` reads."""
    try:
        codec, channels, rate, raw = _parse(content)
    except NotReadable:
        return {"duration": 0.0, "codec": None, "sample_rate": 0, "channels": 0}
    return {"duration": len(raw) / (channels * _width(codec)) / rate, "codec": codec, "sample_rate": rate, "channels": channels}


def _width(codec: str) -> int:
    return next(bits // 8 for (_, bits), c in _KINDS.items() if c == codec)


def decode(content: bytes) -> tuple[np.ndarray, int]:
    """(mono float32 samples, rate) of PCM of 8, 16, 24 or 32 bits, or of floating samples; channels are
    averaged.  ``NotReadable`` for anything else."""
    codec, channels, rate, raw = _parse(content)
    if codec == "pcm_s24le":
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        x = (np.concatenate((np.zeros((len(b), 1), np.uint8), b), 1).copy().view("<i4").ravel() >> 8).astype(np.float64) / (1 << 23)
    elif codec == "pcm_u8":
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif codec in ("pcm_s16le", "pcm_s32le"):
        bits = 8 * _width(codec)
        x = np.frombuffer(raw, f"<i{bits // 8}").astype(np.float64) / (1 << (bits - 1))
    else:
        x = np.frombuffer(raw, f"<f{_width(codec)}").astype(np.float64)
    return x.reshape(-1, channels).mean(1).astype(np.float32), rate


def encode(x: np.ndarray, rate: int, kind: str = "s16", channels: int = 1) -> bytes:
    """WAV of mono samples: s16, s24 or f32 (any other is s16), the same in each channel."""
    x = np.repeat(np.asarray(x, np.float64), channels)
    if kind == "f32":
        raw, bits = x.astype("<f4").tobytes(), 32
    elif kind == "s24":
        whole = np.clip(np.round(x * (1 << 23)), -(1 << 23), (1 << 23) - 1).astype("<i4")
        raw, bits = whole.view(np.uint8).reshape(-1, 4)[:, :3].tobytes(), 24
    else:
        raw, bits = np.clip(np.round(x * 32768), -32768, 32767).astype("<i2").tobytes(), 16
    step = channels * bits // 8
    head = struct.pack("<HHIIHH", 3 if kind == "f32" else 1, channels, rate, rate * step, step, bits)
    body = b"WAVEfmt " + struct.pack("<I", len(head)) + head + b"data" + struct.pack("<I", len(raw)) + raw + b"\0" * (len(raw) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def _put(folder: str, name: str, content: bytes) -> str:
    """Write a file whole, so a task may run twice."""
    os.makedirs(folder, exist_ok=True)
    part, at = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/{name}"
    with open(part, "wb") as w:
        w.write(content)
    os.replace(part, at)
    return at


Decoder = Callable[[bytes, str], tuple[np.ndarray, int]]


def decode_copies(files: DataFrame, folder: str, asr_rate: int, master_rate: int, kind: str = "s16", channels: int = 1, decoder: Decoder | None = None) -> DataFrame:
    """``files`` (book_id, chapter_id, path, content, ...) without the content, with what ``probe`` says
    and two WAV copies of each chapter, asr_wav and master_wav, in ``folder``/book/asr and master.

    What is no WAV goes to ``decoder`` (content, path) -> (mono samples, rate), or without one is
    an error that names the file.  ``folder`` is a mounted shared one."""
    keep = [c for c in files.columns if c != "content"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for book, chapter, path, content in zip(f["book_id"], f["chapter_id"], f["path"], f["content"], strict=True):
                info = probe(content)
                if info["codec"]:
                    x, sr = decode(content)
                elif decoder:
                    x, sr = decoder(content, path)
                    info |= {"duration": len(x) / sr, "sample_rate": sr, "channels": 1, "codec": path.rsplit(".", 1)[-1].lower()}
                else:
                    raise NotReadable(f"no decoder for {path}")
                copies = [_put(f"{folder}/{book}/{name}", f"{chapter}.wav", encode(resample(x, sr, rate), rate, kind, channels)) for name, rate in (("asr", asr_rate), ("master", master_rate))]
                out.append((info["duration"], info["codec"], info["sample_rate"], info["channels"], *copies))
            yield f[keep].assign(**{k: [r[i] for r in out] for i, k in enumerate(("duration", "codec", "sample_rate", "channels", "asr_wav", "master_wav"))})

    schema = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep)
    return files.mapInPandas(run, f"{schema}, duration double, codec string, sample_rate int, channels int, asr_wav string, master_wav string")


def read_wavs(rows: DataFrame, wav: str = "wav") -> DataFrame:
    """``rows`` with the content of the files that ``wav`` names, read where the row is: mounted files
    are opened by their path, so no listing and no join stands between."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for lo in range(0, len(f), 16):  # a few files at a time
                part = f.iloc[lo : lo + 16]
                content = []
                for path in part[wav]:
                    with open(path.removeprefix("file:"), "rb") as r:
                        content.append(r.read())
                yield part.assign(content=content)

    schema = ", ".join(f"`{n.name}` {n.dataType.simpleString()}" for n in rows.schema.fields)
    return rows.mapInPandas(run, f"{schema}, content binary")


def probed(files: DataFrame) -> DataFrame:
    """``files`` (..., content) with what ``probe`` says in place of the content."""
    keep = [c for c in files.columns if c != "content"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [probe(c) for c in f["content"]]
            yield pd.DataFrame({c: f[c].tolist() for c in keep} | {k: [g[k] for g in got] for k in ("duration", "codec", "sample_rate", "channels")})

    schema = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep)
    return files.mapInPandas(run, f"{schema}, duration double, codec string, sample_rate int, channels int")


def samples(files: DataFrame) -> DataFrame:
    """``files`` (..., content) with sr and samples in place of the content; null where it is no WAV."""
    keep = [c for c in files.columns if c != "content"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [decode(c) if probe(c)["codec"] else (None, None) for c in f["content"]]
            yield f[keep].assign(sr=pd.array([r for _, r in got], "Int32"), samples=[x for x, _ in got])

    schema = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep)
    return files.mapInPandas(run, f"{schema}, sr int, samples array<float>")


def levels(files: DataFrame) -> DataFrame:
    """(book_id, chapter_id, sr, frame_len, rms, threshold) of ``files`` (..., content): frames of 20 ms."""

    def one(content: bytes) -> tuple:
        x, sr = decode(content)
        size = max(1, int(sr * 0.02))
        rms = frame_levels(x, size)
        if not len(rms):
            rms = np.sqrt([(x.astype(np.float64) ** 2).sum() / max(1, len(x)) + 1e-12])
        return sr, size, rms, max(float(np.quantile(rms, 0.95)) * 0.15, 1e-4)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [one(c) for c in f["content"]]
            yield f[["book_id", "chapter_id"]].assign(**{k: [g[i] for g in got] for i, k in enumerate(("sr", "frame_len", "rms", "threshold"))})

    return files.mapInPandas(run, "book_id string, chapter_id string, sr int, frame_len int, rms array<double>, threshold double")


def regions(files: DataFrame, min_silence: float, pad: float) -> DataFrame:
    """(book_id, chapter_id, regions) of ``files`` (..., content) by the energy detector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[["book_id", "chapter_id"]].assign(regions=[[{"start": a, "end": b} for a, b in speech_regions(*decode(c), min_silence, pad)] for c in f["content"]])

    return files.mapInPandas(run, "book_id string, chapter_id string, regions array<struct<start:double,end:double>>")


METRICS = "peak double, silence_ratio double, snr_db double, edge_lead_ms double, edge_tail_ms double"


def clip_metrics(clips: DataFrame, edge: dict | None = None) -> DataFrame:
    """``clips`` (..., wav) with ``METRICS`` of their files, levels rounded for the record, edges not.
    ``edge``: settings of ``signal.edge_noise`` with lead_gap_ms and tail_gap_ms; None: no edges.
    An empty file has peak 0 and no silence."""
    keep = clips.columns

    def one(content: bytes) -> tuple:
        x, sr = decode(content)
        size = max(1, int(sr * 0.02))
        rms = frame_levels(x, size)
        if not len(rms):
            rms = np.sqrt(np.array([(x.astype(np.float64) ** 2).sum() / max(1, len(x)) + 1e-12]))
        thr = max(float(np.quantile(rms, 0.95)) * 0.15, 1e-4)
        loud, soft = rms[rms >= thr], rms[rms < thr]
        snr = 10 * np.log10((loud**2).mean() / max((soft**2).mean() if len(soft) else 1e-8, 1e-8)) if len(loud) else 0.0
        levels_ = round(float(np.abs(x).max(initial=0.0)), 4), round(len(soft) / len(rms), 3), round(float(snr), 2)
        if edge is None:
            return *levels_, None, None
        rules = {k: v for k, v in edge.items() if not k.endswith("gap_ms")}
        ends = ((x, edge["lead_gap_ms"]), (x[::-1], edge["tail_gap_ms"]))
        return *levels_, *(S.edge_noise(y, sr, min_gap_ms=gap, **rules) for y, gap in ends)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [one(c) for c in f["content"]]
            yield f[keep].assign(**{c.split()[0]: pd.array([g[i] for g in got], "Float64") for i, c in enumerate(METRICS.split(", "))})

    schema = ", ".join(f"`{n.name}` {n.dataType.simpleString()}" for n in clips.schema.fields)
    return read_wavs(clips).mapInPandas(run, f"{schema}, {METRICS}")


def edge_silences(segments: DataFrame, folder_of: str = "master_wav") -> DataFrame:
    """(strategy, lead, trail): seconds of silence at the ends of ``segments`` (strategy, start, end and
    the path of the chapter's WAV), a chapter's file read once; silent and empty ones are no row."""
    cuts = segments.where(F.col(folder_of).isNotNull()).groupBy(folder_of).agg(F.collect_list(F.struct("strategy", "start", "end")).alias("cuts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for content, cs in zip(f["content"], f["cuts"], strict=True):
                x, sr = decode(content)
                size = max(1, int(sr * 0.02))
                for c in cs:
                    part = x[int(c["start"] * sr) : int(c["end"] * sr)]
                    rms = frame_levels(part, size)
                    if len(part) and not len(rms):
                        rms = np.sqrt(np.array([(part.astype(np.float64) ** 2).mean() + 1e-12]))
                    on = np.flatnonzero(rms >= max(float(np.quantile(rms, 0.95)) * 0.15, 1e-4)) if len(rms) else []
                    if len(on):
                        out.append((c["strategy"], on[0] * size / sr, (len(rms) - 1 - on[-1]) * size / sr))
            yield pd.DataFrame(out, columns=["strategy", "lead", "trail"])

    return read_wavs(cuts, folder_of).mapInPandas(run, "strategy string, lead double, trail double")


def export_wavs(clips: DataFrame, folder: str, sr_out: int, target: float | None) -> DataFrame:
    """Write the files of ``clips`` (book_id, clip_id, wav) at ``sr_out`` as ``folder``/book/wavs/clip.wav,
    brought to ``target`` LUFS where that is given, with peaks under 0.99; a clip whose loudness
    can't be measured (too short, silent) is unchanged.  Returns (book_id, clip_id, lufs, gain)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for book, clip, content in zip(f["book_id"], f["clip_id"], f["content"], strict=True):
                x, sr = decode(content)
                lufs = S.loudness(x, sr) if target is not None else None
                y, g = resample(x, sr, sr_out), 1.0
                if lufs is not None and np.isfinite(lufs):
                    g = 10 ** ((target - lufs) / 20)
                    peak = float(np.abs(y).max(initial=0.0)) * g
                    g *= 0.99 / peak if peak > 0.99 else 1.0
                _put(f"{folder}/{book}/wavs", f"{clip}.wav", encode(y * g, sr_out))
                out.append((book, clip, lufs, g))
            yield pd.DataFrame(out, columns=["book_id", "clip_id", "lufs", "gain"]).astype({"lufs": "float64", "gain": "float64"})

    return read_wavs(clips.select("book_id", "clip_id", "wav")).mapInPandas(run, "book_id string, clip_id string, lufs double, gain double")


def cut_wavs(clips: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """Write ``clips`` (book_id, chapter_id, clip_id, a, b) of ``files`` (book_id, chapter_id,
    content) as ``folder``/book/clip.wav, decoding a chapter once; returns (book_id, clip_id, wav)."""
    cuts = clips.groupBy("book_id", "chapter_id").agg(F.collect_list(F.struct("clip_id", "a", "b")).alias("cuts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for book, content, cs in zip(f["book_id"], f["content"], f["cuts"], strict=True):
                x, sr = decode(content)
                for c in cs:
                    at = _put(f"{folder}/{book}", f"{c['clip_id']}.wav", encode(x[int(c["a"] * sr) : int(c["b"] * sr)], sr))
                    out.append((book, c["clip_id"], at))
            yield pd.DataFrame(out, columns=["book_id", "clip_id", "wav"])

    return cuts.join(files.select("book_id", "chapter_id", "content"), ["book_id", "chapter_id"]).mapInPandas(run, "book_id string, clip_id string, wav string")


def write_wavs(clips: DataFrame, folder: str, sr_out: int | None = None) -> DataFrame:
    """Write ``clips`` (clip_id, sr, samples[, gain]) as WAV files in ``folder``, a mounted shared
    one; returns (clip_id, wav).  A file is put in place whole, so a task may run twice."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            gains = f["gain"] if "gain" in f else [1.0] * len(f)
            out = []
            for clip, sr, x, g in zip(f["clip_id"], f["sr"], f["samples"], gains, strict=True):
                rate = sr_out or int(sr)
                out.append(_put(folder, f"{clip}.wav", encode(resample(np.asarray(x, np.float64), int(sr), rate) * g, rate)))
            yield pd.DataFrame({"clip_id": f["clip_id"], "wav": out})

    return clips.mapInPandas(run, "clip_id string, wav string")
