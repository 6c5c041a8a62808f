"""Record sets on storage: JSON lines, verdict and metadata files, books and their chapters."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import review
from ..schemas import VERDICT

AUDIO = ("opus", "mp3", "m4a", "flac", "wav")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Put ``src`` in the place of ``dst``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(dst).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path(dst), True)
    fs.rename(path(src), path(dst))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a fixed schema; nothing there reads as no record, blank lines are none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def iter_jsonl(spark: SparkSession, path: str, schema: str):
    """Records one after another at the driver, a partition at a time."""
    return read_jsonl(spark, path, schema).toLocalIterator()


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write records, nulls kept, and return their number from the same pass."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def replace_jsonl(df: DataFrame, path: str) -> int:
    """Like ``write_jsonl`` where ``df`` reads ``path``: written beside it, then moved there."""
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    n = write_jsonl(df, beside)
    move(df.sparkSession, beside, path)
    return n


def append_jsonl(df: DataFrame, path: str) -> int:
    return write_jsonl(df, path, "append")


def write_json(row: dict, path: str) -> None:
    """One document, indented, written by the driver on whatever file system the path is."""
    text = json.dumps(row, ensure_ascii=False, indent=2)
    spark = SparkSession.getActiveSession()
    if spark is None or "://" not in path:
        path = path.removeprefix("file:")
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def write_by_book(df: DataFrame, path: str, order: list[str] | None = None) -> int:
    """Write records as a folder for each book_id, in place of those books' alone; their number.
    With ``order`` a book is one file, in that order: for records, not for sound."""
    from pyspark.sql import Observation

    if order:
        df = df.repartition("book_id").sortWithinPartitions("book_id", *order)
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy("book_id")
    out.option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def read_book_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, clip_id, verdict, flags, seq) of ``path``/<book>/verdicts.csv of all books."""
    schema = f"book_id string, {VERDICT}, seq long"
    files = [f for f in (f"{path}/{b}/verdicts.csv" for b in folders(spark, path)) if exists(spark, f)]
    if not files:
        return spark.createDataFrame([], schema)
    d = spark.read.option("header", True).option("recursiveFileLookup", "true").schema(VERDICT).csv(files)
    book = _unquoted(F.regexp_extract(F.input_file_name(), r"([^/]+)/verdicts\.csv", 1))
    return d.select(book.alias("book_id"), *d.columns, F.monotonically_increasing_id().alias("seq"))




def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(clip_id, verdict, flags), the last row of each clip in the file's order."""
    if not exists(spark, path):
        return spark.createDataFrame([], VERDICT)
    d = spark.read.option("header", True).schema(VERDICT).csv(path)
    return review.latest(d.withColumn("seq", F.monotonically_increasing_id()))


def save_verdicts(new: DataFrame, path: str) -> None:
    """Upsert ``new`` (clip_id, verdict, flags, seq) in a verdict file, sorted by clip."""
    spark = new.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    review.upsert(read_verdicts(spark, path), new).select("clip_id", "verdict", "flags").coalesce(1).write.option("header", True).csv(beside)
    move(spark, beside, path)


def write_csv(df: DataFrame, path: str) -> None:
    """A report with a header, nulls empty."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(clip_id, text, wav) of id[.wav]|text[|...] lines; no quoting, lines without id go."""
    part = F.split("value", r"\|")
    wavs = os.path.join(os.path.dirname(path.rstrip("/")), "wavs")
    clip = F.regexp_replace(part[0], r"\.wav$", "")
    d = spark.read.text(path).select(clip.alias("clip_id"), F.coalesce(F.try_element_at(part, F.lit(2)), F.lit("")).alias("text"))
    return d.where("clip_id <> ''").withColumn("wav", F.concat(F.lit(wavs + "/"), "clip_id", F.lit(".wav")))


def read_clips(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Clips from JSON lines, a CSV with a header, or metadata lines, by ending and first line."""
    if path.endswith(".csv"):
        first = spark.read.text(path).first()
        return read_metadata(spark, path) if first and "|" in first[0] else spark.read.option("header", True).csv(path)
    return read_jsonl(spark, path, schema)


def write_metadata(lines: DataFrame, path: str, order: list[str]) -> None:
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; nothing there is none."""
    if not exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(f.getPath().getName() for f in found if f.isDirectory() and not f.getPath().getName().startswith("."))


def books(spark: SparkSession, raw: str, names: list[str] | None = None) -> DataFrame:
    """(book_id, text) of every raw/<book>/book.txt, or of the books named, each of which must have
    its text."""
    schema = "book_id string, text string"
    if names is None:
        names = [n for n in folders(spark, raw) if exists(spark, f"{raw.rstrip('/')}/{n}/book.txt")]
    paths = [f"{raw.rstrip('/')}/{n}/book.txt" for n in names]
    for p in paths:
        if not exists(spark, p):
            raise FileNotFoundError(p)
    if not paths:
        return spark.createDataFrame([], schema)
    d = spark.read.text(paths, wholetext=True)
    return d.select(_unquoted(F.regexp_extract(F.input_file_name(), r"([^/]+)/book\.txt$", 1)).alias("book_id"), F.col("value").alias("text"))


def _unquoted(name):
    """A part of a file's address as the name it stands for."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def chapter_files(spark: SparkSession, raw: str, content: bool = False, names: list[str] | None = None) -> DataFrame:
    """(book_id, chapter_id, order, path[, content]) of raw/<book>/audio files with a known
    ending, in order of name; of the books named only, if so.  Two files of one stem in a book
    are an error when read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw if names is None else [f"{raw.rstrip('/')}/{n}/audio" for n in names if exists(spark, f"{raw.rstrip('/')}/{n}/audio")] or raw)
    if names is not None:
        d = d.where(F.regexp_extract("path", r"([^/]+)/audio/[^/]+$", 1).isin(names))
    if not content:
        d = d.drop("content")
    d = d.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*AUDIO)).where(F.col("path").rlike("/audio/[^/]+$"))
    d = d.withColumn("book_id", F.regexp_extract("path", r"([^/]+)/audio/[^/]+$", 1)).withColumn("chapter_id", T.stem(F.col("path")))
    by = W.partitionBy("book_id")
    same = F.count("*").over(W.partitionBy("book_id", "chapter_id"))
    order = F.row_number().over(by.orderBy(F.regexp_extract("path", "([^/]+)$", 1))) - 1
    d = d.withColumn("order", order).withColumn("chapter_id", F.when(same == 1, F.col("chapter_id")).otherwise(F.raise_error(F.concat(F.lit("two files of one stem: "), "path"))))
    return d.select("book_id", "chapter_id", "order", "path", *(["content"] if content else []))
