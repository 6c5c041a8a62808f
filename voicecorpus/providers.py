"""What the engine does not do itself: recognisers, region detectors, decoders, voices."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import text as T
from .functions.signal import speech_regions
from .schemas import WORDS


class Recogniser(Protocol):
    def transcribe(self, samples: np.ndarray, sr: int) -> dict: ...


class Unsupported:
    """Stands for a provider that is not installed."""

    def __init__(self, what: str):
        self.what = what

    def transcribe(self, samples: np.ndarray, sr: int) -> dict:
        raise NotImplementedError(f"{self.what} is not installed")


#: By the name that ``asr.backend`` gives; a function makes a recogniser once in each worker.
RECOGNISERS: dict[str, Callable[[], Recogniser]] = {}
#: Decoders of compressed audio by file ending: (content, path) -> (mono samples, rate).
DECODERS: dict[str, Callable[[bytes, str], tuple[np.ndarray, int]]] = {}


def recogniser(name: str) -> Callable[[], Recogniser]:
    return RECOGNISERS.get(name) or (lambda: Unsupported(name))


def decoder(content: bytes, path: str) -> tuple[np.ndarray, int]:
    """The registered decoder of a file's ending."""
    ending = path.rsplit(".", 1)[-1].lower()
    if ending not in DECODERS:
        raise NotImplementedError(f"no decoder for .{ending}: {path}")
    return DECODERS[ending](content, path)


_MADE: dict = {}


def transcribe(rows: DataFrame, make: Callable[[], Recogniser], key: str) -> DataFrame:
    """``rows`` (..., content of a WAV) with asr_text and words in place of the content; a worker makes
    a recogniser once (by ``key``) and keeps it for its further tasks.

    ``transcribe`` gives segments' texts and words; texts are joined and stripped, words stripped,
    times and probabilities rounded to three places."""
    from .sources.audio import decode

    keep = [c for c in rows.columns if c != "content"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if key not in _MADE:
                _MADE[key] = make()
            got = [_MADE[key].transcribe(*decode(c)) for c in f["content"]]
            words = [[{"start": round(w["start"], 3), "end": round(w["end"], 3), "word": w["word"].strip(), "prob": round(w.get("prob") or 0.0, 3)} for w in g["words"]] for g in got]
            texts = [(g["text"] if isinstance(g["text"], str) else "".join(g["text"])).strip() for g in got]
            yield f[keep].assign(asr_text=texts, words=words)

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInPandas(run, f"{schema}, asr_text string, words {WORDS}")


def with_transcripts(chapters: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Transcripts made elsewhere, joined by chapter; a chapter without one has none.  asr_text may be
    the segments' texts, which are joined and stripped."""
    text = F.col("asr_text")
    if transcripts.schema["asr_text"].dataType.typeName() == "array":
        text = F.array_join("asr_text", "")
    t = transcripts.select("book_id", "chapter_id", T.strip(text).alias("asr_text"), "words")
    return chapters.join(t, ["book_id", "chapter_id"], "left")


def with_regions(chapters: DataFrame) -> DataFrame:
    """``chapters`` (..., sr, samples) with regions from the energy detector."""
    keep = chapters.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(regions=[[{"start": a, "end": b} for a, b in speech_regions(np.asarray(x), int(r))] for x, r in zip(f["samples"], f["sr"], strict=True)])

    schema = ", ".join(f"`{c}` {chapters.schema[c].dataType.simpleString()}" for c in keep)
    return chapters.mapInPandas(run, f"{schema}, regions array<struct<start:double,end:double>>")


def voices(listed: DataFrame, language: str = "cs") -> DataFrame:
    """The voices (Locale, ...) of a language."""
    return listed.where(F.startswith(F.col("Locale"), F.lit(language)))
