"""aligned_sentences against a plain count of the words that were read right."""

import re
from difflib import SequenceMatcher

from voicecorpus.functions import text as T
from voicecorpus.plans import queries as Q


def test_matched_words_and_scores(spark, tmp_path):
    items = [(i, f"Item{i} opens here with word{i} and more{i}. Then it says other{i} things about part{i} of it.") for i in range(45)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sentences = [(i % 20, i, k, [w.lower() for w in re.findall(T.TOKEN, s)]) for i, t in items for k, s in enumerate(re.split(r"(?<=\.) ", t))]
    want = {}
    for g in range(20):
        mine = sorted(s for s in sentences if s[0] == g)
        book = [(f"b{g:03d}_{i:06d}_{k:04d}", w, len(ws)) for _, i, k, ws in mine for w in ws]
        heard = []
        for i in sorted({s[1] for s in mine}):
            words = [w for _, j, _, ws in mine if j == i for w in ws]
            heard += ["xx" if n % 7 == 3 else w for n, w in enumerate(words)]
        for m in SequenceMatcher(None, [w for _, w, _ in book], heard, autojunk=False).get_matching_blocks():
            for sent, _, n in book[m.a : m.a + m.size]:
                want[sent] = (want.get(sent, (0, n))[0] + 1, n)
    got = {r.seg_id: (r.matched, r.score) for r in Q.QUERIES["aligned_sentences"](spark, str(tmp_path)).collect()}
    assert got == {s: (m, round(m / n, 3)) for s, (m, n) in want.items()} and len(got) == 90
