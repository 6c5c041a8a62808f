import math

import numpy as np

from voicecorpus.llm import langid as L


def brute_word(model, pieces, word, k):
    """Sum over all segmentations, by recursion."""
    s, number = "▁" + word, {n: i for i, n in enumerate(pieces.names)}

    def rest(i):
        if i == len(s):
            return 1.0
        total, one = 0.0, False
        for j in range(i + 1, len(s) + 1):
            p = number.get(s[i:j], -1)
            if p >= 0:
                total += float(model.prob[p, k]) * rest(j)
                one |= j == i + 1
        return total if one else total + L.UNKNOWN * rest(i + 1)

    return rest(0)


TRAIN = [("the thing is that the other was not with the house and they were there", "en"), ("der hund und die katze sind nicht in dem haus und das ist schön", "de")] * 20


def test_forward_sums_all_segmentations():
    m = L.learn([t for t, _ in TRAIN], [x for _, x in TRAIN])
    for w in ("the", "haus", "schön", "ж", "aжb", "x" * 12):
        got = m.rows_of([w])[0]
        assert np.allclose(got, [math.log(brute_word(m, m.pieces, w, k)) for k in range(2)])
    rng = np.random.default_rng(1)
    for n in (39, 40, 41, 80, 500, 3000):
        w = "".join(rng.choice(list("thenwasrdukaz"), n))
        assert np.allclose(m.rows_of([w, "der"])[0], [exact_log(m, w, k) for k in range(2)], rtol=1e-9)


def exact_log(model, word, k):
    """The same sum for words of any length, in fractions of whole numbers."""
    from fractions import Fraction

    s, number = "▁" + word, {n: i for i, n in enumerate(model.pieces.names)}
    sums = [Fraction(1)] + [Fraction(0)] * len(s)
    step = 1 << 200  # enough digits; keeps the fractions short
    for j in range(1, len(s) + 1):
        one = s[j - 1] in number
        total = sums[j - 1] * (0 if one else Fraction(L.UNKNOWN))
        for i in range(max(0, j - model.pieces.longest), j):
            p = number.get(s[i:j], -1)
            if p >= 0:
                total += sums[i] * Fraction(float(model.prob[p, k]))
        scale = step * (1 << max(0, total.denominator.bit_length() - total.numerator.bit_length()))
        sums[j] = Fraction(int(total * scale), scale)
    n, d = sums[-1].numerator, sums[-1].denominator
    return math.log(n >> max(0, n.bit_length() - 60)) + max(0, n.bit_length() - 60) * math.log(2) - math.log(d >> max(0, d.bit_length() - 60)) - max(0, d.bit_length() - 60) * math.log(2)


def test_expected_counts_match_all_segmentations():
    m = L.learn([t for t, _ in TRAIN], [x for _, x in TRAIN])
    p, number = m.prob[:, 0].astype(float), {n: i for i, n in enumerate(m.pieces.names)}
    for w in ("there", "qжthe", "thatthewaswith"):
        s, want, total = "▁" + w, np.zeros(m.pieces.size + 1), 0.0

        def walk(i, weight, used):
            nonlocal total
            if i == len(s):
                total += weight
                for q in used:
                    want[q] += weight
                return
            for j in range(i + 1, len(s) + 1):
                q = number.get(s[i:j], -1)
                if q < 0 and j == i + 1:
                    q = m.pieces.size
                if q >= 0:
                    walk(j, weight * p[q], [*used, q])

        walk(0, 1.0, [])
        got = L.expected(m.pieces, m.pieces.numbers([w]), np.array([len(w) + 1]), p, np.array([3.0]))
        assert np.allclose(got, 3 * want / total)


def test_six_hundred_languages_are_learnt(spark):
    names = [f"x{k:03d}" for k in range(600)]
    word = lambda k: "".join(chr(97 + (k * 7 + i * (k % 23 + 1)) % 26) for i in range(5)) + "".join(chr(97 + int(c)) for c in f"{k:03d}")
    docs = spark.createDataFrame([(k * 10 + i, f"{word(k)} {word(k)}", names[k]) for k in range(600) for i in range(3)], "doc_id long, text string, lang string")
    rows = L.sample(docs, folds=5)
    learnt = {r.lang for r in rows}
    assert len(learnt) == 600 or learnt == {r.lang for r in docs.where(L.fold_of(L.F.col("doc_id"), 5) != 0).select("lang").distinct().collect()}
    m = L.train(docs)
    assert set(m.langs) == learnt and len(learnt) > 500
    lang, score = m.score([word(k) for k in range(600) if names[k] in learnt])
    assert sum(a == names[k] for a, k in zip(lang, [k for k in range(600) if names[k] in learnt], strict=True)) > 0.9 * len(lang)
    assert len(L.sample(docs, languages=7)) <= 7 * 3 and sum(len(r.text) for r in L.sample(docs, chars=4000)) < 60_000


def test_em_probabilities_sum_to_one():
    m = L.learn([t for t, _ in TRAIN], [x for _, x in TRAIN])
    assert np.allclose(m.prob[:-1].sum(0, dtype=float), 1)


def test_edges():
    m = L.learn([t for t, _ in TRAIN], [x for _, x in TRAIN])
    lang, score = m.score([None, "", "12 ... $$", "the house", "die katze " * 40000, "q" * 100_000, "THE! 12 HOUSE"])
    assert lang[:3] == ["und"] * 3 and lang[3] == "en" and lang[4] == "de" and lang[6] == "en" and lang[5] in ("en", "de")
    assert all(0 <= s <= 1 for s in score) and not score[:3].any() and score[3] > 0.9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("lang_pred", L.F.lit("x"))
    m = L.train(docs, 60)
    got = L.predict(docs, m).join(docs.select("doc_id", "lang"), "doc_id").where(L.fold_of(L.F.col("doc_id"), 5) == 0).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got) > 0
    kept = L.keep(docs.withColumn("lang", L.F.when(L.F.col("doc_id") % 2 == 0, L.F.col("lang"))), m)
    assert kept.columns == docs.columns
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(lang[r.doc_id] == r.lang for r in kept.collect()) >= 0.95 * kept.count() > 0
    assert {r.lang for r in L.keep(docs, m, languages={"de"}).collect()} == {"de"}


def test_empty_and_null(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    m = L.train(none)
    assert L.predict(none, m).collect() == []
    df = spark.createDataFrame([(None, "abc"), (1, None), (1, None)], "doc_id long, text string")
    assert sorted(r.lang_pred for r in L.predict(df, m).collect()) == ["und"] * 3
