"""A corpus pipeline: language, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import exact_dedup, language, mixing, near_join, packing
from loomgraph.llm.common import BATCH, LIMIT, in_small_batches, table, written  # noqa: F401


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or mostly in words that none of them reads go."""
    in_small_batches(spark)
    return language.keep_known_language(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id's."""
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (5-word shingles, similarity 0.8): the smallest id's."""
    in_small_batches(spark)
    return near_join.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, none to two times each, in the sources' target weights."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their places in sequences of 4096 tokens."""
    in_small_batches(spark)
    return packing.packed_documents(docs)


STAGES = [
    ("language", known_language),
    ("exact dedup", without_copies),
    ("near copies", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Language models, near-duplicate components and packing can't be expressed in SQL;
#: tests/llm/test_contract.py holds each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
