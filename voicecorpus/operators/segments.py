"""Aligned segments to clips: greedy merging, boundary snapping, padding, numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import signal as S
from ..functions import text as T

_ITEM = "struct<start:double,rank:bigint,end:double,score:double,seg_id:string,text:string,normalized:string>"


def merge_short(segments: DataFrame, keys: list[str], min_duration: float = 1.0, max_duration: float = 15.0, max_gap: float = 1.0) -> DataFrame:
    """Join a segment that is too short with the next one, in order of start, while the gap and
    the joint length allow; scores are averaged in pairs, the first id stays.

    ``segments``: the keys, seg_id, start, end, score, text, normalized and rank (input order,
    which breaks ties).  A fold over each key's array: state moves with every step, so no
    fixed window can say it."""
    items = F.array_sort(F.collect_list(F.struct("start", F.col("rank").cast("long").alias("rank"), "end", "score", "seg_id", "text", "normalized"))).cast(f"array<{_ITEM}>")
    fold = f"""aggregate(items, named_struct('out', cast(array() as array<{_ITEM}>), 'cur', cast(null as {_ITEM})),
      (st, s) -> if(st.cur is null, named_struct('out', st.out, 'cur', s),
        if(st.cur.end - st.cur.start < {min_duration}D and s.start - st.cur.end <= {max_gap}D and s.end - st.cur.start <= {max_duration}D,
          named_struct('out', st.out, 'cur', named_struct('start', st.cur.start, 'rank', st.cur.rank, 'end', s.end, 'score', round((st.cur.score + s.score) / 2, 3),
            'seg_id', st.cur.seg_id, 'text', trim(concat(st.cur.text, ' ', s.text)), 'normalized', trim(concat(st.cur.normalized, ' ', s.normalized)))),
          named_struct('out', concat(st.out, array(st.cur)), 'cur', s))),
      st -> if(st.cur is null, st.out, concat(st.out, array(st.cur))))"""
    merged = segments.groupBy(*keys).agg(items.alias("items")).select(*keys, F.explode(F.expr(fold)).alias("s"))
    return merged.select(*keys, "s.seg_id", "s.start", "s.end", "s.score", "s.text", "s.normalized")


def with_chapters(segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """Segments of known chapters; Spark broadcasts the chapters by their size."""
    return segments.join(chapters, ["book_id", "chapter_id"])


def missing_chapters(segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """Chapters that segments name and that are not there, with how many segments go."""
    lost = segments.join(chapters, ["book_id", "chapter_id"], "left_anti")
    return lost.groupBy("book_id", "chapter_id").agg(F.count("*").alias("segments"))


def cut_clips(merged: DataFrame, pad: float = 0.1, detector: str = "regions", keep: tuple[str, ...] = ()) -> DataFrame:
    """Clips of merged segments (with duration of the chapter, and regions or rms, frame_len,
    sr and threshold): ends snapped to silence, padded, clamped; numbered within the chapter
    before empty ones go.  ``keep``: further columns, among them a and b, the ends unrounded."""
    if detector == "regions":
        start, end = S.snap_start_regions(F.col("regions"), F.col("start")), S.snap_end_regions(F.col("regions"), F.col("end"))
    elif detector == "energy":
        level = F.col("rms"), F.col("frame_len"), F.col("sr"), F.col("threshold")
        start, end = S.snap_start(*level, F.col("start")), S.snap_end(*level, F.col("end"))
    elif detector == "none":
        start, end = F.col("start"), F.col("end")
    else:
        raise ValueError(f"unknown detector: {detector}")
    idx = F.row_number().over(W.partitionBy("book_id", "chapter_id").orderBy("start", "seg_id")) - 1
    # snapped before the window, so no chapter's levels or regions are sorted with its clips
    d = merged.withColumn("a", F.greatest(F.lit(0.0), start - pad)).withColumn("b", F.least(F.col("chapter_duration"), end + pad)).drop("rms", "regions")
    d = d.withColumn("idx", idx)
    d = d.where("b > a").withColumn("clip_id", T.clip_id(F.col("chapter_id"), F.col("idx")))
    return d.select("book_id", "chapter_id", "seg_id", "clip_id", "text", "normalized", F.round("a", 3).alias("start"), F.round("b", 3).alias("end"), F.round(F.col("b") - F.col("a"), 3).alias("duration"), F.col("score").alias("align_score"), *keep)


def region_join(points: DataFrame, regions: DataFrame, key: str) -> DataFrame:
    """As-of join by window: each of ``points`` (key, t, ...) gets the last region (key, start,
    end) that begins by t, and the next one's start.  One shuffle by key and a sort; a key's
    regions are never gathered."""
    names = [c for c in points.columns if c not in (key, "t")]
    p = points.select(key, "t", F.lit(1).alias("__k"), F.struct(*names).alias("__p") if names else F.lit(None).alias("__p"), F.lit(None).cast("double").alias("__s"), F.lit(None).cast("double").alias("__e"))
    r = regions.select(key, F.col("start").alias("t"), F.lit(0).alias("__k"), F.lit(None).cast(p.schema["__p"].dataType).alias("__p"), F.col("start").alias("__s"), F.col("end").alias("__e"))
    up = W.partitionBy(key).orderBy("t", "__k", F.col("__e"))
    past = F.last(F.when(F.col("__k") == 0, F.struct("__s", "__e")), True).over(up.rowsBetween(W.unboundedPreceding, 0))
    after = F.first(F.col("__s"), True).over(up.rowsBetween(1, W.unboundedFollowing))
    d = p.unionByName(r).withColumn("__at", past).withColumn("next_start", after).where("__k = 1")
    return d.select(key, "t", *[F.col(f"__p.{c}").alias(c) for c in names], F.col("__at.__s").alias("region_start"), F.col("__at.__e").alias("region_end"), "next_start")
