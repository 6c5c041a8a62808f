"""The registered queries against their SQL, and the contract's columns of all."""

import pytest

from tests.oracle import connect, same
from voicecorpus.llm import queries as Q

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op7_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op8_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op9_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
}


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_sql(spark, name):
    same(spark, connect(SF), Q.QUERIES[name], Q.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    d = Q.QUERIES[name](spark, SF)
    assert d.columns == COLUMNS[name]
    rows = d.collect()
    if name in ("op1_toxicity", "op2_langid", "op3_simhash", "op7_lm", "op8_fingerprints"):
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    if name == "op9_chat":
        assert -7 in {r.conv_id for r in rows}
    if name == "op7_lm":
        held = [r for r in rows if r.held_out]
        assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
