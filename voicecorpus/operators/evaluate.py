"""Alignment reports by strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ["segments", "audio_seconds", "retained_pct", "mean_score", "dur_mean", "dur_min", "dur_max"]


def ingest_totals(chapters: DataFrame) -> DataFrame:
    """(book_id, chapters, seconds) of ``chapters`` (book_id, duration)."""
    return chapters.groupBy("book_id").agg(F.count("*").alias("chapters"), F.sum("duration").alias("seconds"))


def basic_metrics(segments: DataFrame, available: float) -> DataFrame:
    """A row for each strategy of ``segments`` (strategy, start, end, score), against the
    seconds of audio there are (0 counts as 1)."""
    d = F.col("end") - F.col("start")
    return segments.groupBy("strategy").agg(
        F.count("*").alias("segments"),
        F.round(F.sum(d), 1).alias("audio_seconds"),
        F.round(100 * F.sum(d) / (available or 1.0), 1).alias("retained_pct"),
        F.round(F.avg(F.coalesce("score", F.lit(0.0))), 3).alias("mean_score"),
        F.round(F.avg(d), 2).alias("dur_mean"),
        F.round(F.min(d), 2).alias("dur_min"),
        F.round(F.max(d), 2).alias("dur_max"),
    )


def edge_silence(frames: DataFrame, frame_len: int, sr: int) -> DataFrame:
    """(lead, trail) seconds of each clip of ``frames`` (rms, threshold); null where nothing is voiced."""
    voiced = F.filter(F.transform("rms", lambda x, i: F.when(x >= F.col("threshold"), i)), lambda i: i.isNotNull())
    d = frames.withColumn("__v", voiced)
    step = frame_len / sr
    return d.withColumn("lead", F.array_min("__v") * step).withColumn("trail", (F.size("rms") - 1 - F.array_max("__v")) * step).drop("__v")


def boundary_metrics(frames: DataFrame, frame_len: int, sr: int) -> DataFrame:
    e = edge_silence(frames, frame_len, sr)
    return e.agg(F.round(F.avg("lead"), 3).alias("lead_silence_mean"), F.round(F.avg("trail"), 3).alias("trail_silence_mean"))


def compare(segments: DataFrame, chapters: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """``basic_metrics`` of ``segments`` (book_id, chapter_id, start, end, score, strategy) against the
    seconds of ``chapters`` (book_id, chapter_id, duration), with the mean silence at clips' ends
    where ``edges`` (strategy, lead, trail) is given."""
    m = basic_metrics(segments, chapters.agg(F.sum("duration")).first()[0] or 0.0)
    if edges is None:
        return m
    e = edges.groupBy("strategy").agg(F.round(F.avg("lead"), 3).alias("lead_silence_mean"), F.round(F.avg("trail"), 3).alias("trail_silence_mean"))
    return m.join(e, "strategy", "left")


def report(metrics: DataFrame, strategies: list[str] | None = None) -> DataFrame:
    """A row for each metric, a column for each strategy."""
    names = [c for c in metrics.columns if c != "strategy"]
    long = metrics.select("strategy", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(["strategy"], names, "metric", "value")
    return long.groupBy("metric").pivot("strategy", strategies).agg(F.first("value"))


def format_report(rows: list[dict], strategies: list[str]) -> str:
    """``report`` rows as text of fixed widths."""
    if not strategies:
        return "(no strategies to compare)"
    head = f"{'metric':<20}" + "".join(f"{s:<16}" for s in strategies)
    return "\n".join([head, "-" * len(head), *(f"{r['metric']:<20}" + "".join(f"{r[s]!s:<16}" for s in strategies) for r in rows)])
