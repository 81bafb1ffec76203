"""The corpus pipeline: from raw documents to packed training sequences.

Every stage is one operator applied to all that the stage before kept. Its result is
written as Parquet to the shared folder and read again, so that a lost executor costs
at most the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from duolect.llm import exact_dedup, language_id, line_dedup, packing, simhash
from duolect.llm.common import table
from duolect.session import materialize, ship_package

END_ID = 1
# Words a worker remembers while packing: fewer than by default, as it shares an executor with what earlier stages left.
KNOWN_WORDS = 150_000


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: those without text or without a letter."""
    ship_package(spark)
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the longest stays, then the one with the smallest id."""
    ship_package(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints links of at most four differing bits join the one with the smallest id stays."""
    ship_package(spark)
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences seen in an earlier document, or earlier in the same, are cut out."""
    ship_package(spark)
    return line_dedup.keep_rest(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its training sequence and place there."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, known_words=KNOWN_WORDS)


STAGES = [
    ("language_id", identify),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("line_dedup", cut_repeats),
    ("packing", pack),
]

# Rank-order profiles, near copies, and tokenisers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that stay, packed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
