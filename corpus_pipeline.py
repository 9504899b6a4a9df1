"""The corpus pipeline: stages over documents, each written and reread as the next one's input.

All but the last return documents, with the columns of documents. What each decides holds for
those after it: toxic documents go, one document of each near-duplicate group stays, repeated
passages are cut out of texts, sources are mixed to their targets (a row per draw, so that a
document can occur up to three times), and what is left is packed.

A document of which every word was a repeat stays, with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkzone.llm import mixing, packing, simhash, substrings, toxicity
from sparkzone.llm.common import table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# A trained classifier and a tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
