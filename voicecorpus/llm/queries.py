"""The queries of this subpackage by name, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bottomk, chat, langid, mixing, ngram, packing, simhash, topk, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_langid": langid.op2_langid,
    "op3_simhash": simhash.op3_simhash,
    "op4_mixing": mixing.op4_mixing,
    "op5_packing": packing.op5_packing,
    "op6_url_filter": urlfilter.op6_url_filter,
    "op7_lm": ngram.op7_lm,
    "op8_fingerprints": bottomk.op8_fingerprints,
    "op9_chat": chat.op9_chat,
    "op10_topk": topk.op10_topk,
}

ORACLES: dict[str, str] = {
    "op4_mixing": mixing.ORACLE_SQL,
    "op6_url_filter": urlfilter.ORACLE_SQL,
    "op9_chat": chat.ORACLE_SQL,
    "op10_topk": topk.ORACLE_SQL,
}
