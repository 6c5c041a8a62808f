"""Order-preserving alignment of book tokens with transcribed words."""

from __future__ import annotations

from bisect import bisect_left
from difflib import SequenceMatcher
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

GAP = 0.5


class Aligner(Protocol):
    def align(self, sentences: DataFrame, chapters: DataFrame) -> DataFrame: ...


def book_tokens(sentences: DataFrame, folded: bool = True) -> DataFrame:
    """(book_id, sent_id, order, n_tok, tok_pos, tok, pos): tokens in the book's order (by order, then
    sent_id), folded.  Numbers come from the sentences' counts: what is ordered within a book is
    one narrow row for each sentence, and tokens stay where they are."""
    n = F.greatest(F.size("tokens"), F.lit(0))
    before = F.sum("n").over(W.partitionBy("book_id").orderBy("order", "sent_id").rowsBetween(W.unboundedPreceding, -1))
    at = sentences.select(F.col("book_id").alias("b"), F.col("sent_id").alias("s"), "order", n.alias("n"), F.col("book_id"), F.col("sent_id")).withColumn("base", F.coalesce(before, F.lit(0))).select("b", "s", "base")
    d = sentences.select("book_id", "sent_id", "order", F.size("tokens").alias("n_tok"), "tokens")
    d = d.join(at, d["book_id"].eqNullSafe(at["b"]) & d["sent_id"].eqNullSafe(at["s"]))
    t = d.select("book_id", "sent_id", "order", "n_tok", "base", F.posexplode("tokens").alias("tok_pos", "tok"))
    tok = T.fold(F.col("tok")) if folded else F.col("tok")
    return t.select("book_id", "sent_id", "order", "n_tok", "tok_pos", tok.alias("tok"), (F.col("base") + F.col("tok_pos")).cast("int").alias("pos"))


def asr_tokens(chapters: DataFrame) -> DataFrame:
    """(book_id, idx, tok, chapter_id, start, end) of ``chapters`` (book_id, chapter_id, order,
    words), in order of chapter, word and token within the word."""
    w = chapters.select("book_id", "chapter_id", F.coalesce("order", F.lit(0)).alias("order"), F.posexplode("words").alias("wi", "w"))
    t = w.select("book_id", "chapter_id", "order", "wi", "w.start", "w.end", F.posexplode(T.tokenize(F.col("w.word"))).alias("ti", "tok"))
    idx = F.row_number().over(W.partitionBy("book_id").orderBy("order", "chapter_id", "wi", "ti")) - 1
    return t.select("book_id", idx.alias("idx"), T.fold(F.col("tok")).alias("tok"), "chapter_id", "start", "end")


def match(book: DataFrame, asr: DataFrame) -> DataFrame:
    """(book_id, pos, idx): the longest-block recursive match of a book's two token streams.
    A book's tokens meet in one task, as the match needs them all."""

    def pairs(b: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        b, a = b.sort_values("pos"), a.sort_values("idx")
        out = []
        if len(b) and len(a):
            for m in SequenceMatcher(None, b["tok"].tolist(), a["tok"].tolist(), autojunk=False).get_matching_blocks():
                out += [(m.a + k, m.b + k) for k in range(m.size)]
        key = b["book_id"].iloc[0] if len(b) else a["book_id"].iloc[0]
        return pd.DataFrame({"book_id": pd.Series([key] * len(out), dtype=object), "pos": pd.Series([p for p, _ in out], dtype="int32"), "idx": pd.Series([i for _, i in out], dtype="int32")})

    return book.select("book_id", "pos", "tok").groupBy("book_id").cogroup(asr.select("book_id", "idx", "tok").groupBy("book_id")).applyInPandas(pairs, "book_id string, pos int, idx int")


#: So many runs, of 16 bytes each, are sent to every task at most.
SENT = 200_000


def unique_grams(texts: DataFrame, key: str, at: str, n: int = 8, among: DataFrame | None = None) -> DataFrame:
    """(g1, g2, key, at) of the runs of ``n`` tokens of ``texts`` (key, tokens) that occur once in all: made
    within a text's row, and shuffled as two hashes of 64 bits each.

    Where only runs that are in ``among`` (g1, g2, ...) are wanted and those are ``SENT`` at most, the
    others are left out where they are made and never shuffled; of those in it all are counted.
    Where they are more, all runs are shuffled, and some that are returned may not be in it."""
    folded = F.split(T.fold(F.array_join("tokens", " ")), " ")
    grams = F.transform(F.sequence(F.lit(1), F.size("f") - (n - 1)), lambda i: F.array_join(F.slice(F.col("f"), i, n), " "))
    runs = F.transform(grams, lambda g: F.struct(F.xxhash64(g).alias("g1"), F.xxhash64(g, F.lit(n)).alias("g2")))
    runs = F.when((F.size("f") >= n) & (F.get("f", F.lit(0)) != ""), runs)  # no filter, which would make the tokens again
    d = texts.select(key, folded.alias("f")).select(key, F.posexplode(runs).alias(at, "g")).select(key, at, "g.g1", "g.g2")
    if among is not None and among.limit(SENT + 1).count() <= SENT:
        d = d.join(F.broadcast(among.select("g1", "g2")), ["g1", "g2"], "left_semi")
    d = d.groupBy("g1", "g2").agg(F.count("*").alias("n"), F.min(key).alias(key), F.min(at).alias(at))
    return d.where("n = 1").drop("n")


def anchors(book: DataFrame, asr: DataFrame, n: int = 8) -> DataFrame:
    """(book_id, pos, idx) of runs of ``n`` tokens that occur once on either side, by an equi-join of
    their hashes, in rising order on both: of those that cross, the fewest are left out."""

    def grams(d: DataFrame, at: str) -> DataFrame:
        w = W.partitionBy("book_id").orderBy(at)
        g = F.concat_ws(" ", *[F.lead("tok", k).over(w) for k in range(n)])
        d = d.select("book_id", F.col(at), F.xxhash64(g).alias("g1"), F.xxhash64(g, F.lit(n)).alias("g2"), F.lead("tok", n - 1).over(w).alias("last")).where("last is not null")
        return d.groupBy("book_id", "g1", "g2").agg(F.count("*").alias("n"), F.min(at).alias(at)).where("n = 1").drop("n")

    def rising(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("pos").reset_index(drop=True)
        tails, ends, back = [], [], [-1] * len(f)  # the longest rising run of idx
        for i, v in enumerate(f["idx"].tolist()):
            k = bisect_left(tails, v)
            back[i] = ends[k - 1] if k else -1
            tails[k : k + 1], ends[k : k + 1] = [v], [i]
        keep, i = [], ends[-1] if ends else -1
        while i >= 0:
            keep.append(i)
            i = back[i]
        return f.iloc[keep[::-1]]

    found = grams(book, "pos").join(grams(asr, "idx"), ["book_id", "g1", "g2"]).select("book_id", F.col("pos").cast("int").alias("pos"), F.col("idx").cast("int").alias("idx"))
    return found.groupBy("book_id").applyInPandas(rising, "book_id string, pos int, idx int")


def match_between(book: DataFrame, asr: DataFrame, n: int = 8) -> DataFrame:
    """(book_id, pos, idx) for books too large for one task: ``anchors`` match, and the stretches
    between one and the next are matched as ``match`` does, each in a task of its own."""
    fixed = anchors(book, asr, n)
    none = F.lit(None).cast("int")

    def stretches(d: DataFrame, at: str) -> DataFrame:
        other = "idx" if at == "pos" else "pos"
        marks = fixed.select("book_id", F.col(at), F.lit(None).cast("string").alias("tok"), F.lit(1).alias("mark"))
        both = d.select("book_id", F.col(at).cast("int").alias(at), "tok", F.lit(0).alias("mark")).unionByName(marks)
        part = F.sum("mark").over(W.partitionBy("book_id").orderBy(at, F.col("mark").desc()))
        seen = F.max("mark").over(W.partitionBy("book_id", at))
        return both.withColumns({"part": part, "seen": seen}).where("seen = 0").select("book_id", "part", at, "tok", none.alias(other))

    def pairs(key: tuple, b: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        b, a = b.sort_values("pos"), a.sort_values("idx")
        out = []
        for m in SequenceMatcher(None, b["tok"].tolist(), a["tok"].tolist(), autojunk=False).get_matching_blocks():
            out += zip(b["pos"].iloc[m.a : m.a + m.size], a["idx"].iloc[m.b : m.b + m.size], strict=True)
        return pd.DataFrame([(key[0], p, i) for p, i in out], columns=["book_id", "pos", "idx"]).astype({"pos": "int32", "idx": "int32"})

    keys = ["book_id", "part"]
    left, right = stretches(book, "pos").drop("idx"), stretches(asr, "idx").drop("pos")
    rest = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(pairs, "book_id string, pos int, idx int")
    return fixed.unionByName(rest)


def mode(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """(keys, value): the most frequent value of each key, the first met by ``order`` on a tie."""
    c = rows.groupBy(*keys, value).agg(F.count("*").alias("c"), F.min(order).alias("f"))
    return c.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("c"), F.col("f"))).alias(value))


def word_totals(chapters: DataFrame) -> DataFrame:
    """(book_id, chapters, words) of transcribed ``chapters``; null words count as none."""
    return chapters.groupBy("book_id").agg(F.count("*").alias("chapters"), F.coalesce(F.sum(F.greatest(F.size("words"), F.lit(0)).cast("long")), F.lit(0)).alias("words"))


def spans(pairs: DataFrame, book: DataFrame, asr: DataFrame) -> DataFrame:
    """One row for each matched sentence: counts, span, most frequent chapter (first met on a
    tie), words in order, and what is unmatched before and after."""
    m = pairs.join(book, ["book_id", "pos"]).join(asr.select("book_id", "idx", F.col("tok").alias("word"), "chapter_id", "start", "end"), ["book_id", "idx"])
    key = ["book_id", "sent_id"]
    whole = m.groupBy(*key).agg(
        F.count("*").alias("matched"), F.first("n_tok").alias("total"), F.first("order").alias("order"), F.min("start").alias("start"), F.greatest(F.max("end"), F.min("start")).alias("end"),
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "word"))), lambda x: x["word"]).alias("matched_words"),
        F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.min("tok_pos").alias("lead"), (F.first("n_tok") - 1 - F.max("tok_pos")).alias("trail"),
    )
    return whole.join(mode(m, key, "chapter_id", "idx"), key)


def extend(found: DataFrame, pairs: DataFrame, asr: DataFrame, gap: float = GAP) -> DataFrame:
    """Spans stretched over the unclaimed words at their edges, at most one more than the
    tokens unmatched there, up to a claimed word, another chapter or a pause.

    Only the words within reach are joined to a span, by an equi-join on their numbers, and
    folded in order of distance."""
    claimed = asr.join(pairs.select("book_id", "idx", F.lit(True).alias("claimed")), ["book_id", "idx"], "left")
    words = claimed.select("book_id", "idx", F.col("chapter_id").alias("ch"), F.col("start").alias("ws"), F.col("end").alias("we"), F.coalesce("claimed", F.lit(False)).alias("claimed"))

    def reach(edge: str, n: str, step: int) -> DataFrame:
        near = found.where(F.col(n) > 0).select("book_id", "sent_id", F.col("chapter_id"), F.explode(F.sequence(F.lit(1), F.col(n) + 1)).alias("k"), F.col(edge).alias("at"))
        j = near.withColumn("idx", F.col("at") + step * F.col("k")).join(words, ["book_id", "idx"])
        return j.groupBy("book_id", "sent_id").agg(F.array_sort(F.collect_list(F.struct("k", "ws", "we", (F.col("claimed") | (F.col("ch") != F.col("chapter_id"))).alias("stop")))).alias(edge + "_words"))

    d = found.join(reach("last_idx", "trail", 1), ["book_id", "sent_id"], "left").join(reach("first_idx", "lead", -1), ["book_id", "sent_id"], "left")
    fwd = F.expr(f"aggregate(coalesce(last_idx_words, array()), named_struct('t', `end`, 'on', true), (s, w) -> if(s.on and not w.stop and w.ws - s.t <= {gap}D, named_struct('t', greatest(s.t, w.we), 'on', true), named_struct('t', s.t, 'on', false)), s -> s.t)")
    back = F.expr(f"aggregate(coalesce(first_idx_words, array()), named_struct('t', start, 'on', true), (s, w) -> if(s.on and not w.stop and s.t - w.we <= {gap}D, named_struct('t', least(s.t, w.ws), 'on', true), named_struct('t', s.t, 'on', false)), s -> s.t)")
    return d.withColumns({"end": fwd, "start": back}).drop("last_idx_words", "first_idx_words")


class BridgeAligner:
    """Sentences against transcribed words; ``anchored``: cut at runs of that many tokens first."""

    def __init__(self, anchored: int | None = None):
        self.anchored = anchored

    def align(self, sentences: DataFrame, chapters: DataFrame) -> DataFrame:
        book, asr = book_tokens(sentences), asr_tokens(chapters)
        pairs = match_between(book, asr, self.anchored) if self.anchored else match(book, asr)
        d = extend(spans(pairs, book, asr), pairs, asr).join(sentences.select("book_id", "sent_id", "text", "normalized"), ["book_id", "sent_id"])
        return d.select("book_id", "chapter_id", F.col("sent_id").alias("seg_id"), "text", "normalized", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.round(F.col("matched") / F.col("total"), 3).alias("score"), "matched_words", "order")


class ForcedAligner:
    """Declared, without a back-end."""

    def align(self, sentences: DataFrame, chapters: DataFrame) -> DataFrame:
        raise NotImplementedError("forced alignment needs an external back-end")


def get_aligner(strategy: str) -> Aligner:
    try:
        return {"asr_bridge": BridgeAligner, "forced": ForcedAligner}[strategy]()
    except KeyError:
        raise ValueError(f"unknown alignment strategy: {strategy}") from None


def aligned(segments: DataFrame, min_score: float = 0.7) -> DataFrame:
    return segments.where(F.col("score") >= min_score)
