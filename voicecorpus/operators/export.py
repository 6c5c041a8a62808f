"""Dataset export: split, metadata lines, statistics."""

from __future__ import annotations

import json
import os
import random
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def passed(clips: DataFrame) -> DataFrame:
    """The clips that go into a dataset."""
    return clips.where(F.col("status") == "pass")


def held_rows(n: int, fraction: float = 0.02, seed: int = 42) -> list[int]:
    """Row numbers (from 0) that a seeded shuffle of ``n`` rows puts first: the validation set."""
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return order[: max(1, int(n * fraction))]


def split_shuffled(rows: DataFrame, order: list[str], fraction: float = 0.02, seed: int = 42, by: list[str] | None = None) -> DataFrame:
    """``rows`` with split (train, val) as a seeded shuffle of each group (``by``; all rows, if none) in
    ``order`` gives it.  Groups are shuffled in tasks of their own, by their ids alone: a
    shuffle with one seed is sequential, so a group is a book or the like.  ``order`` names
    columns that tell the rows of a group apart."""
    by = by or []
    keys = [*by, *[c for c in order if c not in by]]
    slim = rows.select(*keys)

    def one(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(order, kind="stable", na_position="first").reset_index(drop=True)
        split = ["train"] * len(f)
        for i in held_rows(len(f), fraction, seed) if len(f) else []:
            split[i] = "val"
        return f.assign(split=split)

    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keys) + ", split string"
    done = slim.groupBy(*by).applyInPandas(one, schema).withColumnsRenamed({c: f"__{c}" for c in keys})
    same = [rows[c].eqNullSafe(done[f"__{c}"]) for c in keys]
    return rows.join(done, reduce(and_, same)).drop(*[f"__{c}" for c in keys])


BUCKETS = 1 << 16


def split_ranked(rows: DataFrame, fraction: float = 0.02, seed: int = 42) -> DataFrame:
    """``rows`` (clip_id, ...) with split: the smallest of md5(clip_id, seed) are val, as many as
    the shuffled split has.  Hashes fall in 65,536 buckets; those are counted, whole buckets go
    to either side, and only the one in which the number is reached is ordered, by its distinct
    clip_ids.  A clip_id may stand in several rows: each counts, and of those of the last one only
    as many are val as are left.  Rows without clip_id come last."""
    rank = F.md5(F.concat(F.col("clip_id").cast("string"), F.lit(f":{seed}")).cast("binary"))
    bucket = F.coalesce(F.conv(F.substring(rank, 1, 4), 16, 10).cast("int"), F.lit(BUCKETS))
    counts = sorted((r.b, r.n) for r in rows.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect())  # BUCKETS + 1 rows at most
    left = max(1, int(sum(n for _, n in counts) * fraction))
    at = -1
    for at, n in counts:  # noqa: B007
        if n >= left:
            break
        left -= n
    inside = rows.where(bucket == at).groupBy(rank.alias("r"), F.col("clip_id").alias("c")).agg(F.count("*").alias("n"))
    last = inside.withColumn("up_to", F.sum("n").over(W.orderBy("r", "c"))).where(F.col("up_to") >= left).orderBy("up_to").limit(1).collect()
    if not last:
        return rows.withColumn("split", F.lit("val"))
    (r, c, n, up_to), key = last[0], F.col("clip_id")
    val = lambda d: F.when(d, "val").otherwise("train")
    if r is None:
        before, same = key.isNotNull(), key.isNull()
    else:
        before = (bucket < at) | ((bucket == at) & ((rank < r) | ((rank == r) & (key < c))))
        same = F.coalesce(key == c, F.lit(False))
    if up_to == left:
        return rows.withColumn("split", val(before | same))
    tied = rows.where(same).withColumn("split", val(F.row_number().over(W.partitionBy("clip_id").orderBy("clip_id")) <= left - (up_to - n)))
    return rows.where(~same).withColumn("split", val(before)).unionByName(tied)


NOTES = """# Training on this dataset

Rows of `metadata.csv` are `{layout}`; `metadata_train.csv` and `metadata_val.csv` are its two parts.
Language `{language}`, {rate} Hz mono WAV files in `wavs/`, one speaker.

```bash
python -m piper_train.preprocess --sample-rate {rate} --single-speaker --dataset-format ljspeech \\
  --output-dir {folder}/prepared --input-dir {folder} --language {language}
```
"""
LAYOUTS = {"piper": "file.wav|text", "ljspeech": "id|text|normalized"}


def notes(folder: str, language: str, rate: int, layout: str) -> str:
    """What the dataset is, and the command that prepares it."""
    return NOTES.format(folder=folder, language=language, rate=rate, layout=LAYOUTS[layout])


def write_books(rows: DataFrame, folder: str, layout: str, language: str, rate: int) -> DataFrame:
    """Write each book's metadata.csv (all, train, val), dataset_stats.json and PIPER.md in
    ``folder``/book, a mounted shared one, and return the statistics by book.

    ``rows``: book_id, clip_id, place (their order), line, split, text, speaker_id, duration.  A book's
    lines, no audio, pass through one task."""
    schema = "book_id string, clips long, total_hours double, duration_min double, duration_max double, duration_mean double, speakers array<string>, char_inventory string, char_count long, val_clips long, sample_rate int"

    def put(path: str, text: str) -> None:
        part = f"{path}.{os.getpid()}"
        with open(part, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(part, path)

    def one(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["place", "clip_id"])
        book, chars = f["book_id"].iloc[0], "".join(sorted(set("".join(f["text"]))))
        here = f"{folder}/{book}"
        os.makedirs(here, exist_ok=True)
        d = f["duration"]
        stats = {
            "clips": len(f), "total_hours": round(float(d.sum()) / 3600, 3), "duration_min": round(float(d.min()), 2), "duration_max": round(float(d.max()), 2), "duration_mean": round(float(d.mean()), 2),
            "speakers": sorted({s for s in f["speaker_id"] if s is not None}), "char_inventory": chars, "char_count": len(chars), "val_clips": int((f["split"] == "val").sum()), "sample_rate": rate,
        }
        for name, part in (("metadata", f), ("metadata_train", f[f["split"] == "train"]), ("metadata_val", f[f["split"] == "val"])):
            put(f"{here}/{name}.csv", "".join(f"{x}\n" for x in part["line"]))
        put(f"{here}/dataset_stats.json", json.dumps(stats, ensure_ascii=False, indent=2))
        put(f"{here}/PIPER.md", notes(here, language, rate, layout))
        return pd.DataFrame([{"book_id": book} | stats])

    return rows.groupBy("book_id").applyInPandas(one, schema)


def metadata_lines(rows: DataFrame, layout: str = "piper") -> DataFrame:
    """``rows`` (clip_id, text, normalized) with line, in either layout."""
    plain = lambda c: F.replace(F.col(c), F.lit("|"), F.lit(" "))
    if layout == "piper":
        line = F.concat(F.col("clip_id"), F.lit(".wav|"), plain("text"))
    elif layout == "ljspeech":
        line = F.concat_ws("|", "clip_id", plain("text"), plain("normalized"))
    else:
        raise ValueError(f"unknown layout: {layout}")
    return rows.withColumn("line", line)


def characters(rows: DataFrame, text: str = "text") -> DataFrame:
    """One row: the distinct characters in order, and how many.  Distinct in partial steps."""
    c = rows.select(F.explode(F.split(F.col(text), "")).alias("c")).where("c <> ''").distinct()
    return c.agg(F.array_join(F.array_sort(F.collect_list("c")), "").alias("char_inventory"), F.count("*").alias("char_count"))


def _total(c: str) -> Column:
    """The sum of a column of doubles, added as decimals, so that it is the same whatever the order of the
    rows; where one is beyond them (or no number), added as doubles."""
    exact = F.col(c).try_cast("decimal(28,15)")
    return F.when(F.count(exact) == F.count(c), F.sum(exact).cast("double")).otherwise(F.sum(c))


def statistics(rows: DataFrame) -> DataFrame:
    """One row over (duration, speaker_id, text)."""
    zero = lambda c, d: F.coalesce(F.round(c, d), F.lit(0.0))
    # a share is taken of the total's own digits, so that halves are rounded up
    share = lambda by, d: zero(F.coalesce(F.round(F.col("total").try_cast("decimal(28,15)") / by, d).cast("double"), F.col("total") / by), d)
    main = rows.agg(
        F.count("*").alias("clips"),
        F.count("duration").alias("known"),
        _total("duration").alias("total"),
        zero(F.min("duration"), 2).alias("duration_min"),
        zero(F.max("duration"), 2).alias("duration_max"),
        F.array_sort(F.collect_set("speaker_id")).alias("speakers"),
    )
    main = main.select("clips", share(F.lit(3600), 3).alias("total_hours"), "duration_min", "duration_max", share(F.nullif("known", F.lit(0)), 2).alias("duration_mean"), "speakers")
    return main.crossJoin(characters(rows))  # one row by one
