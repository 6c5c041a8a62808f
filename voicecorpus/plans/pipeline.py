"""The seven stages by name, run in order, each kept as records in a folder for each book.

A stage reads all books that have its input and are not done, in one plan, and writes their
folders; a mark for each book says that it is done, so a further run takes up what is left.
Spark sizes the work: the settings named jobs, and asr.cpu_threads, have no use here."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import providers, schemas
from ..config import Config, load
from ..operators import alignment, evaluate, export, quality, review, segments, text_prep
from ..sources import audio, records

DETECTORS = ["energy", "silero"]
Stage = Callable[[SparkSession, Config, list[str]], DataFrame]


def _of(spark: SparkSession, cfg: Config, stage: str, schema: str, books: list[str]) -> DataFrame:
    """A stage's records of these books; none of a book is an error that names the stage to run."""
    d = records.read_jsonl(spark, cfg.stage_path(stage), schema).where(F.col("book_id").isin(books))
    there = {r.book_id for r in d.select("book_id").distinct().collect()}  # names of books
    if lost := sorted(set(books) - there):
        raise FileNotFoundError(f"no {stage} records of {', '.join(lost)}; run {stage} first")
    return d


def ingest(spark: SparkSession, cfg: Config, books: list[str]) -> DataFrame:
    """Chapters, probed and decoded to two WAV copies: one for recognisers, one that clips are cut
    from.  Files that are no WAV go to the decoder registered for their ending."""
    files = records.chapter_files(spark, cfg.require("paths.raw"), content=True, names=books)
    rates = {k: int(cfg.require(f"audio.{k}_sample_rate")) for k in ("asr", "master")}
    f = audio.decode_copies(files, f"{cfg.stage_path('ingest')}-wavs", rates["asr"], rates["master"], cfg.require("audio.sample_format"), cfg.require("audio.channels"), providers.decoder)
    book, rate = F.col("book_id"), lambda k: F.lit(rates[k])
    return f.select("book_id", book.alias("speaker_id"), "chapter_id", F.col("path").alias("src_path"), "asr_wav", "master_wav", "codec", "order", F.col("sample_rate").alias("src_sample_rate"), rate("asr").alias("sample_rate_asr"), rate("master").alias("sample_rate_master"), "duration")


def prepare_text(spark: SparkSession, cfg: Config, books: list[str]) -> DataFrame:
    return text_prep.sentence_records(records.books(spark, cfg.require("paths.raw"), books))


def transcribe(spark: SparkSession, cfg: Config, books: list[str]) -> DataFrame:
    """Chapters with what is heard in them.  asr.backend: precomputed reads raw/<book>/transcript.jsonl
    (chapter_id, asr_text, words); any other name is a registered recogniser, made once a worker."""
    chapters, backend = _of(spark, cfg, "ingest", schemas.CHAPTER, books), cfg.require("asr.backend")
    if backend == "precomputed":
        paths = [f"{cfg.require('paths.raw').rstrip('/')}/{b}/transcript.jsonl" for b in books]
        for p in paths:
            if not records.exists(spark, p):
                raise FileNotFoundError(p)
        t = spark.read.schema(f"chapter_id string, asr_text string, words {schemas.WORDS}").json(paths)
        book = records._unquoted(F.regexp_extract(F.input_file_name(), r"([^/]+)/transcript\.jsonl$", 1))
        return providers.with_transcripts(chapters, t.withColumn("book_id", book))
    rows = audio.read_wavs(chapters, "asr_wav")
    return providers.transcribe(rows, providers.recogniser(backend), f"{backend}:{cfg.get('asr')}")


def align(spark: SparkSession, cfg: Config, books: list[str]) -> DataFrame:
    heard, sentences = _of(spark, cfg, "transcribe", schemas.TRANSCRIPT, books), _of(spark, cfg, "text_prep", schemas.SENTENCE, books)
    out = alignment.get_aligner(cfg.require("align.strategy")).align(sentences, heard)
    return alignment.aligned(out, cfg.require("align.min_score"))


def segment(spark: SparkSession, cfg: Config, books: list[str]) -> DataFrame:
    """Clips with their WAV files, cut from the master copies.  segment.vad: silero snaps to speech
    regions of the recogniser's copy, found by the energy detector in the neural one's place;
    energy snaps to pauses in the levels of the master copy's frames."""
    vad = cfg.require("segment.vad")
    if vad not in DETECTORS:
        raise ValueError(f"segment.vad is none of {DETECTORS}: {vad}")
    s = _of(spark, cfg, "align", schemas.SEGMENT, books).withColumn("rank", F.xxhash64("seg_id"))
    chapters = _of(spark, cfg, "ingest", schemas.CHAPTER, books).select("book_id", "chapter_id", "speaker_id", "asr_wav", "master_wav", F.col("duration").alias("chapter_duration"))
    spoken = chapters.join(s.select("book_id", "chapter_id").distinct(), ["book_id", "chapter_id"], "left_semi")
    files = audio.read_wavs(spoken.select("book_id", "chapter_id", "master_wav"), "master_wav")
    if vad == "energy":
        sound = audio.levels(files)
    else:
        sound = audio.regions(audio.read_wavs(spoken.select("book_id", "chapter_id", "asr_wav"), "asr_wav"), cfg.require("segment.vad_min_silence_ms") / 1000, cfg.require("segment.vad_speech_pad_ms") / 1000)
    merged = segments.merge_short(s, ["book_id", "chapter_id"], cfg.require("segment.min_duration"), cfg.require("segment.max_duration"))
    found = segments.with_chapters(merged, chapters.drop("asr_wav", "master_wav").join(sound, ["book_id", "chapter_id"]))
    clips = segments.cut_clips(found, cfg.require("segment.silence_pad"), "energy" if vad == "energy" else "regions", ("speaker_id", "a", "b"))
    wavs = audio.cut_wavs(clips, files, f"{cfg.stage_path('segment')}-wavs")
    return clips.drop("a", "b").join(wavs, ["book_id", "clip_id"])


def check(spark: SparkSession, cfg: Config, books: list[str]) -> DataFrame:
    """Clips measured, graded, and with people's verdicts applied again.  quality.reasr_check hears each
    clip anew by asr.backend; with quality.reasr_reuse those that an earlier run heard keep that."""
    q = lambda k: cfg.require(f"quality.{k}")
    clips = _of(spark, cfg, "segment", schemas.CLIP, books)
    edge = {"frame_ms": int(q("edge_frame_ms")), "strong": q("edge_strong_rel"), "weak": q("edge_weak_rel"), "max_hz": q("edge_max_centroid_hz"), "lead_gap_ms": q("edge_lead_gap_ms"), "tail_gap_ms": q("edge_tail_gap_ms")} if q("edge_noise_check") else None
    d = audio.clip_metrics(clips, edge)
    if q("reasr_check"):
        new = d
        old = records.read_jsonl(spark, f"{cfg.stage_path('quality')}-heard", schemas.HEARD).where(F.col("book_id").isin(books)) if q("reasr_reuse") else None
        if old is not None:
            known, new = quality.with_previous_asr(d, old)
        new = quality.heard(providers.transcribe(audio.read_wavs(new), providers.recogniser(cfg.require("asr.backend")), f"{cfg.require('asr.backend')}:{cfg.get('asr')}").drop("words"))
        d = new if old is None else new.unionByName(known.select(new.columns))
    else:
        d = d.withColumn("cer", F.lit(None).cast("double")).withColumn("asr_text", F.lit(None).cast("string"))
    s = lambda k: cfg.require(f"segment.{k}")
    graded = quality.grade(d, s("min_duration"), s("max_duration"), q("max_silence_ratio"), q("min_snr_db"), q("edge_min_ms"), q("max_cer"), q("review_cer"))
    rounded = graded.withColumns({"edge_lead_ms": F.bround("edge_lead_ms", 0).cast("long"), "edge_tail_ms": F.bround("edge_tail_ms", 0).cast("long"), "cer": F.round("cer", 3)})
    done = review.apply_verdicts(rounded, records.read_book_verdicts(spark, cfg.review_path())).drop("status_before")
    return done.select(*spark.createDataFrame([], schemas.CHECKED).columns)


def dataset(spark: SparkSession, cfg: Config, books: list[str]) -> DataFrame:
    """Passed clips as a dataset for each book: WAV files, metadata of all, train and val, statistics
    and notes.  A book without a passed clip gets none.  Returns the statistics by book."""
    e = lambda k: cfg.require(f"export.{k}")
    if e("format") not in export.LAYOUTS:
        raise ValueError(f"unknown export.format: {e('format')}")
    order = _of(spark, cfg, "ingest", schemas.CHAPTER, books).select("book_id", "chapter_id", "order")
    kept = export.passed(_of(spark, cfg, "quality", schemas.CHECKED, books)).join(order, ["book_id", "chapter_id"], "left")
    wavs = audio.export_wavs(kept, cfg.require("paths.dataset"), int(e("sample_rate")), float(e("loudness_target_lufs")) if e("loudness_normalize") else None)
    rows = export.metadata_lines(kept, e("format")).withColumn("place", F.format_string("%09d %s", F.coalesce("order", F.lit(0)), "clip_id"))
    rows = export.split_shuffled(rows, ["place", "clip_id"], e("val_fraction"), int(e("seed")), by=["book_id"])
    written = rows.join(wavs.select("book_id", "clip_id"), ["book_id", "clip_id"])  # the files are there before the lists
    return export.write_books(written.select("book_id", "clip_id", "place", "line", "split", "text", "speaker_id", "duration"), cfg.require("paths.dataset"), e("format"), cfg.require("language"), int(e("sample_rate")))


STAGES: dict[str, Stage] = {"ingest": ingest, "text_prep": prepare_text, "transcribe": transcribe, "align": align, "segment": segment, "quality": check, "export": dataset}


#: In which order a book's records stand in its file.
ORDER = {"ingest": ["order"], "text_prep": ["order"], "transcribe": ["order"], "align": ["chapter_id", "start", "seg_id"], "segment": ["chapter_id", "clip_id"], "quality": ["chapter_id", "clip_id"], "export": []}


def _after(spark: SparkSession, cfg: Config, stage: str, books: list[str]) -> None:
    """What a stage leaves beside its records: quality what was heard, and the report of flagged clips."""
    if stage != "quality":
        return
    path = cfg.stage_path(stage)
    done = records.read_jsonl(spark, path, schemas.CHECKED).where(F.col("book_id").isin(books))
    records.write_by_book(done.where("asr_text is not null").select("book_id", "clip_id", "cer", "asr_text"), f"{path}-heard")
    _flag(done, f"{path}-flagged")


def _flag(checked: DataFrame, path: str) -> None:
    report = quality.flagged(checked, ["book_id"])
    report.write.mode("overwrite").partitionBy("book_id").option("partitionOverwriteMode", "dynamic").option("header", True).option("emptyValue", "").csv(path)


def run(spark: SparkSession, cfg: Config, stage: str | None = None, from_stage: str | None = None, force: bool = False, stages: dict[str, Stage] = STAGES, book: str | None = None) -> dict[str, int | None]:
    """Run the stages (one, or from one on) over all books, or one; books that a stage has done are
    left, unless forced.  Returns the number of records, None for a stage with nothing to do."""
    for n in (stage, from_stage):
        if n and n not in stages:
            raise ValueError(f"unknown stage: {n}")
    names = list(stages)
    names = [stage] if stage else names[names.index(from_stage) :] if from_stage else names
    books = [book] if book else records.folders(spark, cfg.require("paths.raw"))
    if not books:
        raise FileNotFoundError(f"no books in {cfg.require('paths.raw')}")
    out: dict[str, int | None] = {}
    for n in names:
        path = cfg.stage_path(n)
        mark = lambda b: f"{path}/_done/{b}"  # noqa: E731, B023
        todo = [b for b in books if force or not records.exists(spark, mark(b))]
        out[n] = None
        if not todo:
            continue
        for b in todo:  # not done, and nothing of theirs left, whatever happens now
            records.remove(spark, mark(b))
        made = stages[n](spark, cfg, todo)
        for b in todo:
            records.remove(spark, f"{path}/book_id={b}")
        out[n] = records.write_by_book(made, path, ORDER.get(n))
        _after(spark, cfg, n, todo)
        for b in todo:
            records.touch(spark, mark(b))
    return out


def compare(spark: SparkSession, cfg: Config, book: str, strategies: dict[str, str], sound: bool = True) -> DataFrame:
    """A row of metrics for each strategy (name: path of its segment records) over a book, with the
    silence at clips' ends in the master copies if ``sound``."""
    chapters = _of(spark, cfg, "ingest", schemas.CHAPTER, [book])
    parts = [records.read_jsonl(spark, path, schemas.SEGMENT).where(F.col("book_id") == book).withColumn("strategy", F.lit(name)) for name, path in strategies.items()]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    edges = audio.edge_silences(found.join(chapters.select("book_id", "chapter_id", "master_wav"), ["book_id", "chapter_id"])) if sound else None
    return evaluate.compare(found, chapters, edges)


def apply_review(spark: SparkSession, checked: str, verdicts: str, flagged: str) -> dict | None:
    """Verdicts over a checked record set, rewritten in place with its report; None, and
    nothing is rewritten, where there are no verdicts.  A missing record set is an error."""
    if not records.exists(spark, checked):
        raise FileNotFoundError(checked)
    clips, v = records.read_jsonl(spark, checked, schemas.CHECKED), records.read_verdicts(spark, verdicts)
    if v.isEmpty():
        return None
    counts = review.outcome(clips, v).first().asDict()
    records.replace_jsonl(review.apply_verdicts(clips, v).drop("status_before"), checked)
    records.write_csv(quality.flagged(records.read_jsonl(spark, checked, schemas.CHECKED)), flagged)
    return counts


def apply_book_review(spark: SparkSession, cfg: Config, book: str) -> dict | None:
    """The same for one book's records of the quality stage and its verdicts: only its folder is
    rewritten, beside it first."""
    path = cfg.stage_path("quality")
    clips = _of(spark, cfg, "quality", schemas.CHECKED, [book])
    v = records.read_book_verdicts(spark, cfg.review_path()).where(F.col("book_id") == book)
    if v.isEmpty():
        return None
    counts = review.outcome(clips, v).first().asDict()
    beside = f"{path}-{book}.new"
    records.write_by_book(review.apply_verdicts(clips, v).drop("status_before"), beside)
    records.move(spark, f"{beside}/book_id={book}", f"{path}/book_id={book}")
    records.remove(spark, beside)
    _flag(_of(spark, cfg, "quality", schemas.CHECKED, [book]), f"{path}-flagged")
    return counts


def main(words: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="voicecorpus")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run")
    r.add_argument("--stage")
    r.add_argument("--from-stage")
    r.add_argument("--book")
    r.add_argument("--force", action="store_true")
    sub.add_parser("list-books")
    sub.add_parser("review-apply").add_argument("book")
    t = sub.add_parser("listen")
    t.add_argument("clips")
    t.add_argument("--status")
    t.add_argument("--flag")
    t.add_argument("--random", action="store_true")
    c = sub.add_parser("compare")
    c.add_argument("book")
    c.add_argument("strategies", nargs="+", metavar="NAME=PATH")
    for s in sub.choices.values():
        s.add_argument("--config", default=argparse.SUPPRESS)
    args = p.parse_args(words)
    cfg, spark = load(args.config), SparkSession.builder.appName("voicecorpus").getOrCreate()
    if args.command == "run":
        for name, n in run(spark, cfg, args.stage, args.from_stage, args.force, book=args.book).items():
            print(name, "kept" if n is None else n)
    elif args.command == "list-books":
        for b in records.folders(spark, cfg.require("paths.raw")):
            print(b)
    elif args.command == "listen":
        clips = records.read_clips(spark, args.clips, schemas.CHECKED)
        for c in quality.select_for_listening(clips, args.status, args.flag, args.random).toLocalIterator():
            print(c.clip_id, c.text, c.wav, sep="\t")
    elif args.command == "compare":
        named = dict(x.split("=", 1) for x in args.strategies)
        rows = evaluate.report(compare(spark, cfg, args.book, named), list(named)).collect()
        print(evaluate.format_report([r.asDict() for r in rows], list(named)))
    else:
        print(apply_book_review(spark, cfg, args.book))
    return 0
