"""A training-data pipeline over ``documents``: language, toxicity, near-duplicates, mixing
and packing, each stage written as Parquet in the shared folder and read by the next.

All stages take repeated rows, null and repeated ids, and columns of any names beside those of
``documents``; an empty table gives an empty one, at every stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from voicecorpus.llm import langid, mixing, packing, simhash, toxicity
from voicecorpus.llm.shared import cut, remove, shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learnt from the labelled ones, with ``lang`` set to what was found
    (rows without a label get one, wrong ones are put right).  Null texts, texts without a
    letter and those that no language stands out for (a score under ``langid.MIN_SCORE``; even
    scores among them) go.  Equal texts fare alike; where no row has a label nothing is learnt,
    so all go."""
    return langid.keep(docs, langid.train(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier clean than toxic, as ``labels`` has it (a score under 0.5).  Null
    and empty texts stay, and so does everything where ``labels`` is empty, of one kind, or
    names no document; a document that is labelled both ways counts as both in learning."""
    return toxicity.clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one of the smallest id (ids before
    null, then by a hash of the text).  Null and empty texts are one group.  Linked as
    op3's contract has it (four-word shingles, 4 bits), so most near copies that share 80 % of
    their five-word shingles stay; see the README for their measured recall."""
    return simhash.keep_one(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document stands as often as it is taken, and not if it isn't.  A null source is
    a source of its own; documents without words are in no copy.  Ties in the permutation
    fall by doc_id, size, then text, so reruns agree."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a copy, with its sequence and offset.  Null and empty texts are
    their end id alone; every copy is a document of its own; ties are packed in the order of
    (doc_id, piece, ...)."""
    return packing.packed(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing_sources),
    ("packing", best_fit_packing),
]

#: Trained models and a graph's components are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, written; what the stages before it wrote is deleted as soon as
    the next has been written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
        docs = spark.read.parquet(out)
    last = cut(STAGES[-1][1](spark, docs, sf_dir))
    remove(spark, folder)
    return last
