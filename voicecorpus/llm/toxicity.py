"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

The kernel of two strings sums, over their common subsequences of ``ORDER`` letters, the
decay to the power of the lengths that the subsequence spans in each: a gap or an inserted
letter costs a factor and loses no match.  It is normalised to 1 for equal strings.

A text is a bag of units: its words, lower-cased, without signs, marked at both ends, and
runs of single letters joined to one ("i d i o t").  Landmarks are chosen among the units of
labelled sentences; the Nyström map k(x, landmarks) K^(-1/2) takes units to vectors, and a
linear SVM on them is trained by multiple-instance learning: a toxic sentence's witness is
its highest-scoring unit, all units of clean sentences are negative, and witnesses are chosen
anew from each SVM.  A document scores as its highest unit, and a logistic fit on the
training documents turns that into a probability.  Witnesses with a letter put in at a
random place are positive examples too, so that the SVM gives such insults room.

A sentence's own kernel would be the sum over its words, normalised; one insult among fifteen
words then moves it little, and an SVM on sentences caught half of what the one on
witnesses does (figures in the README), so the kernel stays at words.

The SVM's decision is linear in the kernel's feature space, so the landmarks fold into one
table of weights by letter triple: a unit's score is a sum over its own triples, divided
by its norm, whatever the number of landmarks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fold_of

ORDER, DECAY, LANDMARKS, FOLDS, ROUNDS, INSERTED = 3, 0.6, 640, 5, 2, 2
#: Bounds of what the classifier is fitted on: labelled documents of either kind, and of the clean
#: ones' distinct units those searched for hard examples, those every SVM starts from, and the
#: highest-scoring ones that each round adds.
SAMPLE_TOXIC, SAMPLE_CLEAN, MINED, POOL, HARD = 1000, 2000, 40_000, 6_000, 3_000
WINDOW = 20  # a longer unit is scored by windows of this many letters, half of one apart
_CACHE_UNITS = 300_000
_SIGNS = re.compile(r"[^\w\s]|_")
_SENTENCE = re.compile(r"[.!?\n]+")
_SINGLES = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")


def units_of(text: str | None) -> set[str]:
    """The distinct units of a text, without marks."""
    plain = _SIGNS.sub("", (text or "").lower())
    out = set(plain.split())
    if sum(len(u) == 1 for u in out) > 1 or _SINGLES.search(plain):
        out |= {re.sub(r"\s+", "", m) for m in _SINGLES.findall(plain)}
    out = {intern(u) for u in out if not u.isdigit()}
    for u in [u for u in out if len(u) > WINDOW]:
        out.discard(u)
        out |= {u[a : a + WINDOW] for a in range(0, len(u) - WINDOW // 2, WINDOW // 2)}
    return out


@lru_cache(64)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples of a string of ``n`` and the decay to the power of their spans."""
    t = np.array(list(combinations(range(n), ORDER)), np.int64).reshape(-1, ORDER)
    return t, (DECAY ** (t[:, -1] - t[:, 0] + 1)).astype(np.float64)


def _codes(units: list[str]) -> np.ndarray:
    """Code points of marked units of one length."""
    return np.array([f"\x02{u}\x03" for u in units], f"<U{len(units[0]) + 2}").view(np.uint32).reshape(len(units), -1).astype(np.int64)


def self_kernel(x: np.ndarray) -> np.ndarray:
    """k(x, x) of each row, by the kernel's recursion with the inner sums as products."""
    m, n = x.shape
    eq = (x[:, :, None] == x[:, None, :]).astype(np.float64) * DECAY**2
    tri = np.triu(DECAY ** np.maximum(np.arange(n)[None] - np.arange(n)[:, None], 0).astype(float))
    prev = np.ones((m, n + 1, n + 1))  # of order 0
    for _ in range(ORDER - 1):
        now = np.zeros((m, n + 1, n + 1))
        for a in range(n):
            now[:, a + 1, 1:] = DECAY * now[:, a, 1:] + (eq[:, a] * prev[:, a, :n]) @ tri
        prev = now
    return (eq * prev[:, :n, :n]).sum((1, 2))


class Features:
    """Triples of letters that landmarks have, numbered as columns."""

    def __init__(self, landmarks: list[str]):
        letters = sorted({c for u in landmarks for c in f"\x02{u}\x03"})
        self.size = len(letters) + 1  # 0: any other letter
        self.points = np.array([ord(c) for c in letters], np.int64)
        self.column = np.zeros(self.size**ORDER, np.int32)
        codes = np.unique(np.concatenate([self._raw(_codes([u])).ravel() for u in landmarks]))
        codes = codes[codes > 0]
        self.column[codes] = np.arange(1, len(codes) + 1)
        self.columns = len(codes) + 1

    def triples(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(column (row, triple), weight (triple)); column 0 for a triple that no landmark has."""
        return self.column[self._raw(x)], _triples(x.shape[1])[1]

    def _raw(self, x: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.points, x), len(self.points) - 1)
        c = np.where(self.points[at] == x, at + 1, 0)
        t, _ = _triples(x.shape[1])
        parts = [c[:, t[:, k]] for k in range(ORDER)]
        code = (parts[0] * self.size + parts[1]) * self.size + parts[2]
        code[(parts[0] == 0) | (parts[1] == 0) | (parts[2] == 0)] = 0
        return code

    def project(self, units: list[str], tables: np.ndarray) -> np.ndarray:
        """(unit, column): normalised kernel sums against ``tables`` (column of ``triples``, any), whose row 0 is 0."""
        out = np.zeros((len(units), tables.shape[1]))
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        lo = 0
        while lo < len(order):
            n = len(units[order[lo]])
            room = max(1, 400_000 // (len(_triples(n + 2)[1]) * tables.shape[1]))
            hi = lo
            while hi < len(order) and hi - lo < room and len(units[order[hi]]) == n:
                hi += 1
            rows = order[lo:hi]
            x = _codes([units[i] for i in rows])
            code, w = self.triples(x)
            norm = np.sqrt(np.maximum(self_kernel(x), 1e-300))
            out[rows] = np.einsum("mtc,t->mc", tables[code], w) / norm[:, None]
            lo = hi
        return out

    def table(self, landmarks: list[str]) -> np.ndarray:
        """(column, landmark): each landmark's normalised feature vector."""
        out = np.zeros((self.columns, len(landmarks)), np.float32)
        for k, u in enumerate(landmarks):
            x = _codes([u])
            code, w = self.triples(x)
            np.add.at(out[:, k], code[0], w / np.sqrt(max(float(self_kernel(x)[0]), 1e-300)))
        out[0] = 0
        return out


_BLOCK = 1024  # rows worked on at once, so that learning holds the examples once, as floats of 4 bytes


def _mapped(f: Features, units: list[str], table: np.ndarray, root: np.ndarray) -> np.ndarray:
    """(unit, landmark): the Nyström map of units."""
    out = np.empty((len(units), root.shape[1]), np.float32)
    for lo in range(0, len(units), _BLOCK):
        out[lo : lo + _BLOCK] = f.project(units[lo : lo + _BLOCK], table) @ root
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0, steps: int = 30) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton's method; the last coefficient is the bias."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        grad, curve = ridge @ w, ridge.copy()
        for lo in range(0, len(x), _BLOCK):
            part, sign = x[lo : lo + _BLOCK].astype(np.float64), y[lo : lo + _BLOCK]
            part = np.concatenate((part, np.ones((len(part), 1))), 1)
            m = sign * (part @ w)
            on = m < 1
            c, part = cost * weight[lo : lo + _BLOCK][on], part[on]
            grad -= part.T @ (c * sign[on] * (1 - m[on]))
            curve += (part * c[:, None]).T @ part
        step = np.linalg.solve(curve, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logistic(d: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """a, b of P(y) = 1 / (1 + exp(-(a d + b))), with Platt's smoothed targets."""
    n1, n0 = (y > 0).sum(), (y == 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack((d, np.ones(len(d))), 1)
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t) + 1e-4 * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return float(w[0]), float(w[1])


class Model:
    """``table``: weight by column of triples; without one (nothing to learn from), every score is 0."""

    def __init__(self, features: Features | None, table: np.ndarray | None, bias: float, scale: tuple[float, float]):
        self.features, self.table, self.bias, self.scale = features, table, bias, scale
        self.known: dict[str, float] = {}

    def decisions(self, bags: list) -> np.ndarray:
        """The highest decision of each bag's units (of no unit: the bias); the cache is bounded."""
        if len(self.known) > _CACHE_UNITS:
            self.known = {}
        new = list({u for bag in bags for u in bag if u not in self.known})
        for lo in range(0, len(new), 50_000):
            part = new[lo : lo + 50_000]
            self.known.update(zip(part, self.features.project(part, self.table)[:, 0].tolist(), strict=True))
        get = self.known.__getitem__
        return np.array([max(map(get, bag), default=0.0) for bag in bags]) + self.bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.features is None:
            return np.zeros(len(texts))
        out, lo = [], 0
        while lo < len(texts):
            bags: list[set[str]] = []
            n = 0
            while lo < len(texts) and (n < 100_000 or not bags):
                bags.append(units_of(texts[lo]))
                n += len(bags[-1])
                lo += 1
            out.append(self.decisions(bags))
        d = np.concatenate(out) if out else np.zeros(0)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * d + b, -35, 35)))


def _inserted(unit: str, rng: np.random.Generator) -> list[str]:
    """The unit with a letter put in at random places inside; none for a short unit."""
    if len(unit) < 5 or len(unit) >= WINDOW:
        return []
    out = []
    for _ in range(INSERTED):
        at = int(rng.integers(1, len(unit)))
        out.append(unit[:at] + "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(0, 26))] + unit[at:])
    return out


def learn(texts: list[str | None], toxic: list[int], landmarks: int = LANDMARKS, rounds: int = ROUNDS, seed: int = 5, mined: int = MINED, pool: int = POOL, hard: int = HARD) -> Model:
    """The model from labelled texts, by their sentences.

    Of the clean texts' distinct units, ``mined`` drawn at random and all that toxic texts have
    too are searched for hard examples; each SVM sees ``pool`` of the former and the ``hard``
    highest-scoring ones of each round before it.  Null texts have no unit; repeated rows count
    each; labels of one kind only give a model that scores everything 0."""
    y = np.array(toxic, int)
    if not (y == 1).any() or not (y == 0).any():
        return Model(None, None, 0.0, (0.0, 0.0))
    rng = np.random.default_rng(seed)
    sentences = [[tuple(b) for s in _SENTENCE.split(t or "") if (b := units_of(s))] for t in texts]
    bags = [tuple(units_of(t).union(*s)) for t, s in zip(texts, sentences, strict=True)]  # a third of the sets' memory
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    df1, df0 = Counter(), Counter()
    for bag, label in zip(bags, y, strict=True):
        (df1 if label else df0).update(bag)
    # how far a unit stands out in toxic documents, in standard deviations
    p = {u: (df1[u] + df0[u]) / (n1 + n0) for u in df1}
    z = {u: (df1[u] / n1 - df0[u] / n0) / np.sqrt(p[u] * (1 - p[u]) * (1 / n1 + 1 / n0) + 1e-12) for u in df1}
    order = sorted((u for u in z if len(u) > 1), key=lambda u: (-z[u], u))
    common = [u for u, _ in sorted(df0.items(), key=lambda kv: (-kv[1], kv[0])) if len(u) > 2 and z.get(u, 0) < 2]
    marks = order[: 2 * landmarks // 3]
    marks = sorted({*marks, *common[: landmarks - len(marks)]})
    if not marks:
        return Model(None, None, 0.0, (0.0, 0.0))
    f = Features(marks)
    table = f.table(marks)
    k = f.project(marks, table)
    val, vec = np.linalg.eigh((k + k.T) / 2)
    root = vec / np.sqrt(np.maximum(val, 1e-6)) @ vec.T
    clean = sorted(df0)
    drawn = [clean[i] for i in rng.permutation(len(clean))[:mined]]
    seen = drawn[:pool]
    value = {u: z[u] for u in z}  # the first witnesses: what stands out most
    w = None
    for _ in range(rounds):
        witnesses: Counter = Counter()
        for label, of in zip(y, sentences, strict=True):
            if label:
                best = max(((value.get(u, -np.inf), u) for s in of for u in s), default=None)
                if best is not None and best[0] > (4.0 if w is None else 0.0):
                    witnesses[best[1]] += 1
                    # every sentence of the document whose best unit is as clear has a witness too
                    for s in of:
                        b = max((value.get(u, -np.inf), u) for u in s)
                        if b[0] >= 0.7 * best[0] and b[1] != best[1]:
                            witnesses[b[1]] += 1
        if not witnesses:
            break
        pos = sorted(witnesses)
        neg = sorted(set(seen) - set(pos))
        like = [(v, u) for u in pos for v in _inserted(u, rng) if v not in df0]
        x = _mapped(f, [*pos, *neg, *[v for v, _ in like]], table, root)
        target = np.concatenate((np.ones(len(pos)), -np.ones(len(neg)), np.ones(len(like))))
        share = lambda us: np.array([witnesses[u] for u in us], float) / sum(witnesses.values())
        weight = np.concatenate((share(pos), np.full(len(neg), 2 / max(1, len(neg))), share([u for _, u in like]) / INSERTED)) * 500
        # a unit of both kinds counts on both sides, by how often
        both = [u for u in pos if df0[u]]
        if both:
            x = np.concatenate((x, _mapped(f, both, table, root)))
            target = np.concatenate((target, -np.ones(len(both))))
            weight = np.concatenate((weight, np.array([df0[u] / n0 for u in both]) * 500))
        w = _svm(x, target, weight)
        model = Model(f, (table @ (root @ w[:-1])).astype(np.float64)[:, None], float(w[-1]), (1.0, 0.0))
        units = sorted({*df1, *drawn})
        score = f.project(units, model.table)[:, 0] + model.bias
        value = dict(zip(units, score.tolist(), strict=True))
        closest = [u for u in sorted((u for u in value if df0[u]), key=lambda u: -value[u])[:hard] if value[u] > -1]
        seen = sorted({*seen, *closest})
    if w is None:
        return Model(None, None, 0.0, (0.0, 0.0))
    model.scale = _logistic(model.decisions(bags), y)
    model.known = {}
    return model


def sample(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, most: tuple[int, int] = (SAMPLE_CLEAN, SAMPLE_TOXIC)) -> list:
    """(text, toxic) rows to learn from: whole labelled documents out of no held-out fold, up
    to ``most`` of each label by a hash of doc_id.  Their ids are found in the labels alone
    and sent to the scan of the documents, so no text is shuffled; an id's labels count once
    each, and rows with null label or text are left out."""
    ids = labels.where("toxic is not null and doc_id is not null").where(fold_of(F.col("doc_id"), folds) != 0).select("doc_id", "toxic").distinct()
    pick = ids.where("toxic = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most[0]).unionByName(ids.where("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most[1]))
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(pick), "doc_id")  # at most sum(most) ids
    return sorted((r.text, r.toxic) for r in rows.select("text", "toxic").limit(2 * sum(most)).collect())


def train(docs: DataFrame, labels: DataFrame, **kw) -> Model:
    rows = sample(docs, labels, **kw)
    return learn([t for t, _ in rows], [t for _, t in rows])


def _scored(df: DataFrame, model: Model, schema: str | None, keep) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)  # a table of at most letters^3 weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            at = b.schema.get_field_index("text")
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield keep(part, m.score(part.column(at).to_pylist()))

    return df.mapInArrow(run, schema or df.schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row; a null text counts as empty, and an empty one
    has the score of no unit.  Repeated rows and null ids each get their row (equal texts the
    same score); other columns are not read; an empty table gives an empty one.  Long texts
    count whole: a text scores as its highest unit, wherever that stands."""

    def keep(part: pa.RecordBatch, score: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _scored(d, model, "doc_id long, score double, predicted int", keep)


def clean(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``most``, with all their columns, whatever their
    names.  Null and empty texts have no unit and stay; repeated rows stay or go together."""
    return _scored(docs, model, None, lambda part, score: part.filter(pa.array(score < most)))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out")
    return predict(docs, train(docs, labels)).select("doc_id", held, "score", "predicted")
