"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities for the pieces of one fixed public vocabulary, learnt by
expectation-maximisation.  A word's probability in a language is the sum, by a forward
algorithm, of the products of its pieces' probabilities over all its segmentations; a
text's is the product over its words.  Words are lower-cased runs of letters of any length,
with the vocabulary's mark of a word's begin before them: the forward algorithm keeps the
places that a piece can still reach and scales them as it goes, so a run without a blank is
summed over all its segmentations too.  A letter that is no piece counts as one of a small
fixed probability, the same in each language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, fold_of, sized

VOCABULARY, ROUNDS, FOLDS, UNKNOWN, MIN_SCORE = "piece_bpe_32k.model", 4, 5, 1e-8, 0.4
#: Bounds of what is learnt from: documents of each language, letters of all languages together
#: (shared evenly, but some ``LEAST`` documents of each in any case), and languages.
SAMPLE, SAMPLE_CHARS, LEAST, LANGUAGES = 600, 16_000_000, 8, 1000
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE_WORDS, _CACHE_CELLS, _BATCH_CELLS, _RESCALE = 250_000, 8_000_000, 2_000_000, 8


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def _batches(words: list[str], langs: int, longest: int) -> Iterator[list[str]]:
    """Words, shortest first, in batches whose tables stay within a few dozen megabytes."""
    order = sorted(words, key=lambda w: (len(w), w))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        room = min(8192, max(1, _BATCH_CELLS // ((longest + 1) * langs)))
        while hi < len(order) and hi - lo < room and (hi + 1 - lo) * (len(order[hi]) + 1) <= _BATCH_CELLS:
            hi += 1
        yield order[lo:hi]
        lo = hi


class Pieces:
    """A trie of the vocabulary's pieces over some letters, walked for many words at once.

    ``step`` (state, letter) is the next state or -1, ``piece`` a state's piece or -1.  Words
    are rows of letter numbers: 0 past the end and for letters outside ``letters``, 1 the
    mark of a beginning."""

    def __init__(self, letters: str, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
        number = {"▁": 1} | {c: i + 2 for i, c in enumerate(sorted(set(letters)))}
        self.names: list[str] = []
        root: dict = {}
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or any(c not in number for c in p) or "▁" in p[1:]:
                continue
            at = root
            for c in p:
                at = at.setdefault(number[c], {})
            at[0] = len(self.names)
            self.names.append(p)
        self.size = len(self.names)
        self.longest = max(map(len, self.names), default=1)
        nodes, rows, piece = [root], [], []
        for at in nodes:  # grows as it runs
            row = np.full(len(number) + 1, -1, np.int32)
            for c, child in at.items():
                if c:
                    row[c] = len(nodes)
                    nodes.append(child)
            rows.append(row)
            piece.append(at.get(0, -1))
        self.step, self.piece = np.stack(rows), np.array(piece, np.int32)
        self.table = np.zeros(max([0, *map(ord, number)]) + 2, np.int32)
        for c, i in number.items():
            self.table[ord(c)] = i

    def numbers(self, words: list[str]) -> np.ndarray:
        """Rows of letter numbers of ▁word."""
        n = max(map(len, words), default=0)
        points = np.array(words, f"<U{max(1, n)}").view(np.uint32).reshape(len(words), -1)
        mark = np.ones((len(words), 1), np.int32)
        return np.concatenate((mark, self.table[np.minimum(points, len(self.table) - 1)]), 1)

    def walk(self, rows: np.ndarray, at: int, end: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(words, place after, pieces) of all pieces that begin at ``at``; piece ``size`` is a
        letter that is none."""
        live = np.flatnonzero(end > at)
        state = np.zeros(len(live), np.int32)
        for j in range(at, rows.shape[1]):
            state = self.step[state, rows[live, j]]
            piece = np.where(state >= 0, self.piece[state], -1)
            if j == at:
                none = piece < 0
                if none.any():
                    yield live[none], j + 1, np.full(int(none.sum()), self.size)
            found = piece >= 0
            if found.any():
                yield live[found], j + 1, piece[found]
            on = state >= 0
            live, state = live[on], state[on]
            if not len(live):
                return


def forward(pieces: Pieces, rows: np.ndarray, end: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """(word, language): log of the sum over all segmentations; ``prob`` (piece + 1, language).

    A ring holds the places from the present one to the farthest that a piece reaches, and
    every few places it is divided by the present one's sums, so words of any length neither
    underflow nor take up memory."""
    ring_size = pieces.longest + 1
    ring = np.zeros((len(rows), ring_size, prob.shape[1]))
    ring[:, 0] = 1
    scale, out = np.zeros((len(rows), prob.shape[1])), np.zeros((len(rows), prob.shape[1]))
    for i in range(rows.shape[1] + 1):
        at = i % ring_size
        done = np.flatnonzero(end == i)
        if len(done):
            out[done] = scale[done] + np.log(ring[done, at])
        if i and i % _RESCALE == 0:
            live = np.flatnonzero(end > i)
            now = ring[live, at]
            ring[live] /= now[:, None]
            scale[live] += np.log(now)
        for w, j, p in pieces.walk(rows, i, end):
            ring[w, j % ring_size] += ring[w, at] * prob[p]
        ring[:, at] = 0
    return out


def expected(pieces: Pieces, rows: np.ndarray, end: np.ndarray, p: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How often each piece is expected over the segmentations of words that stand ``times`` each."""
    n, reach = rows.shape[1], pieces.longest + 1
    alpha = np.zeros((len(rows), n + 1))
    alpha[:, 0] = 1
    log_alpha, scale = np.zeros((len(rows), n + 1)), np.zeros(len(rows))

    def rescale(table: np.ndarray, i: int) -> None:
        now = np.where(table[:, i] > 0, table[:, i], 1.0)
        table[:, i : i + reach] /= now[:, None]
        scale[:] += np.log(now)

    for i in range(n + 1):
        log_alpha[:, i] = scale + np.log(np.where(alpha[:, i] > 0, alpha[:, i], 1.0))
        if i and i % _RESCALE == 0:
            rescale(alpha, i)
        for w, j, q in pieces.walk(rows, i, end):
            alpha[w, j] += alpha[w, i] * p[q]
    total = log_alpha[np.arange(len(end)), end]
    beta = np.zeros_like(alpha)
    beta[np.arange(len(end)), end] = 1
    scale[:] = 0
    seen = np.zeros(pieces.size + 1)
    for i in range(n - 1, -1, -1):
        here = np.exp(log_alpha[:, i] + scale - total) * times
        for w, j, q in pieces.walk(rows, i, end):
            way = p[q] * beta[w, j]
            beta[w, i] += way
            seen += np.bincount(q, here[w] * way, pieces.size + 1)
        if i % _RESCALE == 0:
            rescale(beta, i)
    return seen


class Model:
    """``prob`` (piece + 1, language); a worker keeps a bounded number of words' scores."""

    def __init__(self, langs: list[str], prob: np.ndarray, pieces: Pieces):
        self.langs, self.prob, self.pieces = langs, prob, pieces
        self.known: dict[str, int] = {}
        self.room = max(1, min(_CACHE_WORDS, _CACHE_CELLS // max(1, len(langs))))
        self.rows = np.zeros((min(1024, self.room), len(langs)))

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Each word's log probability in each language, for at most ``room`` words."""
        new = {w for w in words if w not in self.known}
        if len(self.known) + len(new) > self.room:
            self.known = {}
            new = set(words)
        for part in _batches(list(new), max(1, len(self.langs)), self.pieces.longest):
            base = len(self.known)
            if base + len(part) > len(self.rows):
                self.rows = np.concatenate((self.rows, np.zeros((max(len(part), len(self.rows)), len(self.langs)))))
            end = np.fromiter(map(len, part), np.int64, len(part)) + 1
            self.rows[base : base + len(part)] = forward(self.pieces, self.pieces.numbers(part), end, self.prob)
            self.known.update(zip(part, range(base, base + len(part)), strict=True))
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A language for each text, and its share of the evidence of up to ten words."""
        lang, out, lo = [], [], 0
        while lo < len(texts):
            flat: list[str] = []
            at = [0]
            while lo < len(texts) and (len(flat) < 100_000 or len(at) == 1):
                flat += words_of(texts[lo])
                at.append(len(flat))
                lo += 1
            n = np.diff(at)
            total = np.zeros((len(n), len(self.langs)))
            for a in range(0, len(flat), self.room):  # one text may have any number of words
                part = flat[a : a + self.room]
                row = np.searchsorted(at, np.arange(a, a + len(part)), "right") - 1
                np.add.at(total, row, self.rows_of(part))
            logit = total * (np.minimum(n, 10) / np.maximum(n, 1))[:, None]
            share = np.exp(logit - logit.max(1, keepdims=True, initial=-np.inf)) if len(self.langs) else np.zeros((len(n), 0))
            for k in range(len(n)):
                if not n[k] or not self.langs:
                    lang.append("und")
                    out.append(0.0)
                else:
                    b = int(total[k].argmax())
                    lang.append(self.langs[b])
                    out.append(float(share[k, b] / share[k].sum()))
        return lang, np.array(out)


def learn(texts: list[str], langs: list[str], rounds: int = ROUNDS, path: str | None = None, smooth: float = 20.0) -> Model:
    """Piece probabilities of each language by EM over the words of its texts."""
    names = sorted(set(langs))
    counts = {name: Counter() for name in names}
    for t, lang in zip(texts, langs, strict=True):
        counts[lang].update(words_of(t))
    pieces = Pieces("".join({c for count in counts.values() for w in count for c in w}), path)
    prob = np.zeros((pieces.size + 1, len(names)), np.float32)
    for k, name in enumerate(names):
        parts = []
        for part in _batches(list(counts[name]), 1, pieces.longest):
            n = np.array([counts[name][w] for w in part], float)
            parts.append((pieces.numbers(part), np.array([len(w) + 1 for w in part]), n))
        p = np.full(pieces.size + 1, 1 / max(1, pieces.size))
        for _ in range(rounds):
            p[-1] = UNKNOWN
            seen = sum((expected(pieces, rows, end, p, n) for rows, end, n in parts), np.zeros(pieces.size + 1))
            p = (seen + smooth / max(1, pieces.size)) / (seen[:-1].sum() + smooth)
        p[-1] = UNKNOWN
        prob[:, k] = p
    return Model(names, prob, pieces)


def sample(docs: DataFrame, per_lang: int = SAMPLE, chars: int = SAMPLE_CHARS, languages: int = LANGUAGES, folds: int = FOLDS) -> list:
    """(text, lang) rows to learn from: about ``per_lang`` whole documents of each language, drawn
    by a hash of doc_id, out of those in no held-out fold.

    What comes to the driver is bounded in letters too: about ``chars`` in all, an even share
    for each language, but some ``LEAST`` documents of each however long they are.  Every
    language is learnt up to ``languages`` of them, the most frequent ones beyond (documents
    of others still get a prediction).  Rows with null text, lang or doc_id are left out."""
    train = docs.where("lang is not null and text is not null and doc_id is not null").where(fold_of(F.col("doc_id"), folds) != 0)
    counts = train.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c"))
    known = cut(counts.orderBy(F.desc("n"), "lang").limit(languages))
    share = chars / max(1, known.count())
    rate = F.least(F.lit(1.0), per_lang / F.col("n"), F.greatest(LEAST / F.col("n"), share / F.greatest("c", F.lit(1))))
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    picked = train.select("doc_id", "text", "lang").join(sized(known.select("lang", rate.alias("rate"))), "lang").where(u < F.col("rate"))
    return picked.select("text", "lang").collect()


def train(docs: DataFrame, per_lang: int = SAMPLE, **kw) -> Model:
    rows = sorted((r.text, r.lang) for r in sample(docs, per_lang))
    return learn([t for t, _ in rows], [x for _, x in rows], **kw)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row: ``und`` and 0 if the text is null, has no
    letter, or nothing was learnt.  Repeated rows and null ids each get their row; other
    columns are not read; an empty table gives an empty one.  Long texts count whole."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                lang, score = m.score(b.column(1).slice(lo, 1024).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, 1024), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, min_score: float = MIN_SCORE, languages: set[str] | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is in a learnt language (one of ``languages``, if given)
    with a score of at least ``min_score``.  ``lang``, if there and text, becomes the language
    that was found, so it holds for rows that had none or a wrong one; all other columns pass
    as they are, whatever their names.  Null texts and texts without a letter go; repeated
    rows stay or go together; an empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    marks = "lang" in docs.columns and docs.schema["lang"].dataType.typeName() == "string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            at = b.schema.get_field_index("text")
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                lang, score = m.score(part.column(at).to_pylist())
                if marks:
                    i = part.schema.get_field_index("lang")
                    part = part.set_column(i, part.schema.field(i), pa.array(lang, part.schema.field(i).type))
                yield part.filter(pa.array([x != "und" and s >= min_score and (languages is None or x in languages) for x, s in zip(lang, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out")
    return predict(docs, train(docs)).select("doc_id", held, "lang_pred", "score")
