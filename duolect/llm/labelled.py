"""Labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duolect.llm.common import whole


def held_out(folds: int, fold: int) -> Column:
    """Whether a document is kept out of learning, by its id alone; so is one without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds, F.lit(fold)) == fold


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents outside the fold: label (double), half (0 or 1), text.

    Documents are taken in order of a hash of their id, so the sample does not depend on
    how the tables are split. Of several labels of a document the largest counts; null
    labels do not. The chosen ids, at most ``rows``, are broadcast.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(folds, fold))
              .groupBy("doc_id").agg(F.max(F.col(label)).cast("double").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
              .select(F.col("doc_id").alias("chosen"), "label", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")))
    return (docs.select("doc_id", whole(F.col("text").cast("string")).alias("text"))
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("label", "half", "text"))
