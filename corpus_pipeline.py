"""The corpus pipeline: quality rules, toxicity, near-duplicates, personal data, packing.

Each stage calls one operator of ``voltaic.llm`` on all rows that the stage before it kept. ``run`` writes
each stage's rows to the shared folder and reads them again for the next one, so a lost executor costs at
most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltaic.llm import packing, pii, quality, simhash, toxicity
from voltaic.llm.common import store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without the lines that failed."""
    return quality.keep_clean(docs)


def toxic_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; the classifier learns from ``labels``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash links stays, the one with the smallest id."""
    return simhash.keep_one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind."""
    return pii.redact(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_language),
    ("simhash_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed_sequences),
]

#: SQL cannot express these stages; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
