"""Clip grading by declarative rules, and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import FLAGGED

HARD = ("duration", "silence", "cer_high")


def grade(clips: DataFrame, min_duration: float = 1.0, max_duration: float = 15.0, max_silence: float = 0.5, min_snr: float = 10.0, edge_min_ms: float = 40.0, max_cer: float = 0.20, review_cer: float = 0.10) -> DataFrame:
    """``clips`` with flags and status.  Reads duration, peak, silence_ratio, snr_db, and as
    they are there edge_lead_ms, edge_tail_ms (before rounding) and cer; a null metric raises
    no flag.  Levels are compared as rounded for the record."""
    has = set(clips.columns)
    edge = F.greatest(*[F.col(c) for c in ("edge_lead_ms", "edge_tail_ms")]) if {"edge_lead_ms", "edge_tail_ms"} <= has else F.lit(None)
    cer = F.col("cer") if "cer" in has else F.lit(None)
    flags = F.array_compact(
        F.array(
            F.when((F.col("duration") < min_duration) | (F.col("duration") > max_duration), "duration"),
            F.when(F.round("peak", 4) >= 0.999, "clipping"),
            F.when(F.round("silence_ratio", 3) > max_silence, "silence"),
            F.when(F.round("snr_db", 2) < min_snr, "low_snr"),
            F.when(edge >= edge_min_ms, "edge_noise"),
            F.when(cer > max_cer, "cer_high").when(cer > review_cer, "cer_review"),
        )
    )
    hard = F.arrays_overlap(F.col("flags"), F.array(*[F.lit(x) for x in HARD]))
    return clips.withColumn("flags", flags).withColumn("status", F.when(hard, "reject").when(F.size("flags") > 0, "review").otherwise("pass"))


def with_previous_asr(clips: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clips whose text was heard before, with cer and asr_text; those still to hear).  Two
    branches, so a provider's function sees no row of the first.  Clips are told apart by
    clip_id, and book_id where both sides have it; of several earlier rows one counts."""
    keys = [c for c in ("book_id", "clip_id") if c in clips.columns and c in previous.columns]
    seen = previous.where("asr_text is not null").groupBy(*keys).agg(F.max(F.struct("asr_text", "cer")).alias("h")).select(*keys, "h.cer", "h.asr_text")
    bare = clips.drop("cer", "asr_text")
    return bare.join(seen, keys), bare.join(seen, keys, "left_anti")


def all_heard(clips: DataFrame, previous: DataFrame) -> bool:
    """Whether every clip was heard before, so that no recogniser is needed."""
    return with_previous_asr(clips, previous)[1].isEmpty()


def status_counts(checked: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return checked.agg(F.count("*").alias("clips"), n("pass"), n("review"), n("reject"))


def flagged(checked: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Rows that did not pass, in the report's columns, after those in ``also``."""
    cols = [T.flags_text(F.col("flags")).alias("flags") if c == "flags" else F.col(c) if c in checked.columns else F.lit(None).cast("string").alias(c) for c in FLAGGED]
    return checked.where("status <> 'pass'").select(*(also or []), *cols)


def heard(clips: DataFrame, reference: str = "normalized") -> DataFrame:
    """``clips`` (..., asr_text) with cer, the error rate of what was heard against the label; null
    where nothing was, or the label has no letter."""
    return clips.withColumn("cer", T.cer(F.col(reference), F.col("asr_text")))


def select_for_listening(clips: DataFrame, status: str | None = None, flag: str | None = None, shuffle: bool = False) -> DataFrame:
    """By status and by a flag, whether flags are an array or joined text; in another order each
    time if ``shuffle``."""
    if status:
        clips = clips.where(F.col("status") == status)
    if flag:
        f = F.col("flags") if clips.schema["flags"].dataType.typeName() == "array" else T.flags_array(F.col("flags"))
        clips = clips.where(F.array_contains(f, flag))
    return clips.orderBy(F.rand()) if shuffle else clips
