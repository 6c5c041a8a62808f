"""Human verdicts: upsert, application, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERDICTS = ("approve", "reject")


def latest(verdicts: DataFrame, by: str = "seq") -> DataFrame:
    """The last row of each clip: one aggregation, no window."""
    cols = [c for c in verdicts.columns if c not in ("clip_id", by)]
    return verdicts.groupBy("clip_id").agg(F.max_by(F.struct(*cols), F.col(by)).alias("v")).select("clip_id", "v.*")


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old verdicts with new ones (which have seq) over them; any other verdict is an error."""
    bad = new.where(~F.col("verdict").isin(*VERDICTS) | F.col("verdict").isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"unknown verdict: {bad[0].verdict!r}")
    return latest(old.withColumn("seq", F.lit(-1).cast("long")).unionByName(new)).orderBy("clip_id")


def _keys(clips: DataFrame, verdicts: DataFrame) -> list[str]:
    """clip_id, and book_id where both sides have it: ids of clips are one book's."""
    return [c for c in ("book_id", "clip_id") if c in clips.columns and c in verdicts.columns]


def _one(clips: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One verdict for each clip: the last by seq where that is there; else a rejection holds."""
    last = F.max_by("verdict", "seq") if "seq" in verdicts.columns else F.max("verdict")  # approve < reject
    return verdicts.groupBy(*_keys(clips, verdicts)).agg(last.alias("verdict"))


def apply_verdicts(clips: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``clips`` with verdict, and status after it: reject always holds, approval lifts review
    only.  A clip stays one row, however many verdicts there are on it."""
    d = clips.drop("verdict").join(_one(clips, verdicts), _keys(clips, verdicts), "left")
    lifted = F.col("verdict").isNotNull() & (F.col("status") == "review")
    return d.withColumn("status_before", F.col("status")).withColumn("status", F.when(F.col("verdict") == "reject", "reject").when(lifted, "pass").otherwise(F.col("status")))


def stale(clips: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts on clips that are not there."""
    return verdicts.join(clips, _keys(clips, verdicts), "left_anti")


def outcome(clips: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row: approved (lifted from review), rejected, stale."""
    done = apply_verdicts(clips, verdicts)
    lifted = (F.col("status_before") == "review") & (F.col("status") == "pass")
    counts = done.agg(F.count_if(lifted).alias("approved"), F.count_if(F.col("verdict") == "reject").alias("rejected"))
    return counts.crossJoin(stale(clips, verdicts).agg(F.count("*").alias("stale")))  # one row by one
