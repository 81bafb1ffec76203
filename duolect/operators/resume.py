"""Skipping finished samples, and which of several rows with one key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolect.operators.shards import with_row_index
from duolect.session import materialize

KEY = ("direction", "sample_id")


def drop_done(df: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """Rows whose key is not finished yet."""
    return df.join(done.select(*keys), list(keys), "left_anti")


def flag_done(df: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """All rows, with ``done`` set on those already finished."""
    finished = done.select(*keys).distinct().withColumn("done", F.lit(True))
    return (df.join(finished, list(keys), "left")
              .withColumn("done", F.coalesce("done", F.lit(False))))


def first_success_wins(df: DataFrame, keys: tuple[str, ...] = KEY, order: str = "idx") -> DataFrame:
    """After the first ``ok`` row of a key, its later rows become ``skipped``;
    failures before it stay errors.

    Who wins is settled on key columns alone: per-key minima are combined before the
    shuffle, only keys with more than one row are joined back, and what comes out is
    the order of the rows that lose. These are stored, so the join with the full rows
    broadcasts them whenever they are few, and audio then moves nowhere. ``df`` is read
    twice: hand in stored rows. ``order`` is unique.
    """
    first_ok = F.min(F.when(F.col("status") == "ok", F.col(order)))
    winners = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), first_ok.alias("_first_ok"))
               .where((F.col("_rows") > 1) & F.col("_first_ok").isNotNull()).drop("_rows"))
    late = F.coalesce(F.col(order) > F.col("_first_ok"), F.lit(False))
    losers = materialize(df.select(*keys, order).join(winners, list(keys)).where(late)
                         .select(F.col(order).alias("_loser")), "losers")
    marked = (df.join(losers, F.col(order) == F.col("_loser"), "left")
              .withColumn("_late", F.col("_loser").isNotNull()))
    changes = {"status": F.when(F.col("_late"), "skipped").otherwise(F.col("status"))}
    for column in ("error_kind", "error_msg", "error"):
        if column in df.columns:
            changes[column] = F.when(~F.col("_late"), F.col(column))
    return marked.withColumns(changes).select(*df.columns)


def repeat_ranks(df: DataFrame, keys: tuple[str, ...] = KEY, order: str = "idx") -> DataFrame:
    """``(order, rank)`` of the rows whose key has several: 0 for its first row, 1 for
    the next, and so on. Ranking goes by bounded buckets, so one key that holds much
    of the manifest is no hot task, and only key columns are read."""
    narrow = df.select(*keys, order)
    shared = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
    repeated = narrow.join(shared, list(keys), "left_semi")
    return with_row_index(repeated, order, keys, restart=True, name="rank").select(order, "rank")


def across_batches(df: DataFrame, batch: str, keys: tuple[str, ...] = KEY, order: str = "idx") -> DataFrame:
    """``(order, later)`` of the rows whose key has rows in several batches: ``later`` is
    false in the key's first batch. Only key columns are read."""
    narrow = df.select(*keys, order, batch)
    shared = (narrow.groupBy(*keys).agg(F.min(batch).alias("_first"), F.max(batch).alias("_last"))
              .where("_first < _last").drop("_last"))
    return narrow.join(shared, list(keys)).select(order, (F.col(batch) > F.col("_first")).alias("later"))


def rank_within_key(df: DataFrame, keys: tuple[str, ...] = KEY, order: str = "idx",
                    ranks: DataFrame | None = None) -> DataFrame:
    """Add ``rank``; most keys have a single row, which is its key's rank 0."""
    repeated = repeat_ranks(df, keys, order) if ranks is None else ranks
    return (df.join(repeated, order, "left")
              .withColumn("rank", F.coalesce("rank", F.lit(0).cast("bigint"))))
