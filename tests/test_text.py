import random
import re

import pytest

from voicecorpus.functions import text as T
from voicecorpus.operators import text_prep
from voicecorpus.plans import queries as Q


def col(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.v for r in df.select("i", f(T.F.col("t")).alias("v")).orderBy("i").collect()]


SENTENCES = {
    "Byla tma. Kdo tam je? Nikdo!": 3,
    "Bydlel na ul. Dlouhé. Pak odešel.": 2,
    "Přijel 5. května ráno. Odjel brzy.": 2,
    "Dlouhá věta\nna dvou řádcích. Druhá.": 2,
    "Bez tečky\n\nDruhý odstavec": 2,
    "Napsal to J. Novák. Potom prof. Malý dodal: ano.": 2,
    "Ticho… Potom hluk. „Co je?“ zeptal se.": 3,
    "V roce 1989. Praha žila.": 2,
    "Čekal... ale nic.": 1,
    "": 0,
    " \n\n ": 0,
}


def test_sentences(spark):
    got = col(spark, T.sentences, list(SENTENCES))
    assert {t: len(s) for t, s in zip(SENTENCES, got, strict=True)} == SENTENCES


def plain_sentences(text):
    """The rule as a scan, boundary by boundary."""
    out = []
    for lines in re.compile(r"\n\s*\n").split(text):
        p = re.sub("[ \t]+", " ", " ".join(x.strip() for x in lines.strip().split("\n")))
        start = 0
        for m in re.finditer(r"[.!?…]+(?=\s)", p):
            nxt = p[m.end() :].lstrip()
            if not nxt or not re.match(T.OPENERS, nxt):
                continue
            if set(m[0]) == {"."}:
                word = re.search(f"[{T.TOKEN_LETTERS}]+$", p[: m.start()], re.I)
                if word:
                    w = word[0]
                    if any(w.lower() in ws for ws in T.NO_STOP.values()) or (len(w) == 1 and w.isalpha()):
                        continue
                    if w.isdigit() and not re.match(f"[{T.CAPITALS}]", nxt):
                        continue
            out.append(p[start : m.end()].strip())
            start = m.end()
        out.append(p[start:].strip())
    return [s for s in out if s]


def test_sentences_match_a_scan_on_random_text(spark):
    rng = random.Random(4)
    bits = ["Ano", "ne", "ul", "s", "5", "12", "Dr", "př", "Žluť", "„A", "…", ".", ".", "!", "?", "..", " ", " ", "\n", "\n\n", "(x", "kč", "J"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    assert col(spark, T.sentences, texts) == [plain_sentences(t) for t in texts]


def test_abbreviations_and_numbers(spark):
    assert col(spark, T.expand_abbreviations, ["To je např. toto, tzn. nic.", "NAPŘ. a Kapitola, kap. 2, cca pět, Viz tab."]) == ["To je například toto, to znamená nic.", "Například a Kapitola, kapitola 2, cirka pět, Viz tabulka"]
    got = col(spark, T.expand_numbers, ["123", "3,5", "1 234", "0", "2 000 000", "rok 1989!", None])
    assert got == ["sto dvacet tři", "tři celá pět", "tisíc dvě stě třicet čtyři", "nula", "dva miliony", "rok tisíc devět set osmdesát devět!", None]


def test_number_words_agree(spark):
    rng = random.Random(3)
    ns = [0, 1, 2, 5, 11, 12, 19, 20, 21, 100, 101, 999, 1000, 1001, 2000, 4999, 5000, 11000, 12000, 22000, 10**6, 3 * 10**6, 10**9, 10**12 - 1] + [rng.randint(0, 10**12 - 1) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    assert [r.w for r in df.select(T.number_words(T.F.col("n")).alias("w")).collect()] == [T.spoken(n) for n in ns]


def test_small_functions(spark):
    assert col(spark, T.tokenize, ["Ahoj, Světe_2 ×!"]) == [["ahoj", "světe", "2", "×"]]
    assert col(spark, T.fold, ["Žluťoučký KŮŇ", "naïve"]) == ["zlutoucky kun", "naive"] == col(spark, T.fold_exact, ["Žluťoučký KŮŇ", "naïve"])
    assert col(spark, T.clean_text, [" a \t b… – c — "]) == ["a b... - c -"]
    assert col(spark, T.normalize, ["  Viz  kap. 3… "]) == ["Viz kapitola tři..."]
    assert col(spark, lambda c: T.cer(T.F.lit("Ábc d"), c), ["abc d", "abd", ""]) == [0.0, 0.4, 1.0]
    assert col(spark, T.xml_escape, ["a<b>&c"]) == ["a&lt;b&gt;&amp;c"]
    assert col(spark, T.last_json_block, ["x {1} y {\"a\": 2} z", "none"]) == ['{"a": 2}', None]
    assert col(spark, T.stem, ["/x/01.a.opus", "b"]) == ["01.a", "b"]
    assert col(spark, lambda c: T.sentence_id(c, T.F.lit(123456)), ["b"]) == ["b_s123456"]


@pytest.mark.parametrize("f", [T.clean_text, T.normalize, T.fold_text, T.xml_escape])
def test_null_stays_null(spark, f):
    assert col(spark, f, [None]) == [None]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "part"), [("sentence_stats", "flatten("), ("sentence_records", "regexp_extract_all("), ("normalized_sentences", "ArrowEvalPython")])
def test_texts_are_split_and_numbers_spelled_once(spark, name, part):
    assert plan(Q.QUERIES[name](spark, "/root/testdata/sf0.001")).count(part) == 1


def test_strip_takes_all_white_space(spark):
    white = [chr(i) for i in range(1, 0x3100) if re.match(r"\s", chr(i)) and not 0x1C <= i <= 0x1F]
    assert set(white) == set(T.WHITE)
    assert col(spark, T.strip, [w + "a" + w for w in white] + ["\x1ca", "\u200ba"]) == ["a"] * len(white) + ["\x1ca", "\u200ba"]


def test_fragments_without_a_token_are_those_of_the_normal_form(spark):
    rng = random.Random(6)
    bits = ["č.", "Viz", "cca", "5", "1 234", "?!", "…", " ", " ", "\n", "\n\n", "ſ", "İ", "-", ". A", "! „", "\u0001"]
    texts = [(str(k), "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))) for k in range(300)]
    books = spark.createDataFrame(texts, "book_id string, text string")
    got = {r.sent_id: (r.text, r.normalized, r.tokens) for r in text_prep.sentence_records(books).collect()}
    d = text_prep.split_books(books).select("book_id", "order", T.clean_text(T.F.col("sentence")).alias("t"), T.normalize(T.F.col("sentence")).alias("n")).withColumn("k", T.tokenize(T.F.col("n")))
    assert got == {f"{r.book_id}_s{r.order:05d}": (r.t, r.n, r.k) for r in d.collect() if r.k}
