"""Helpers the text operators share."""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what counts as white space throughout, U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"

# A key with more than one row in so many is joined by broadcast: at most that many keys can have so many rows.
HEAVY_SHARE = 1000
# Rows of a group that compare with one copy of what its rows share.
SALT_ROWS = 4096
# A join of few keys with many rows: a runtime filter on the keys keeps other rows out of the shuffle, however small the tables.
FILTER_SETTINGS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}
# Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 4 << 20

# Characters of a long text handled at a time.
SLAB = 1 << 20
ANY_SPACE = re.compile(r"\s")


def slabs(text: str, size: int = SLAB) -> Iterator[str]:
    """The text in slabs of about ``size`` characters, each cut before white space."""
    at = 0
    while at < len(text):
        space = ANY_SPACE.search(text, at + size)
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


def packed(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


_HELD: dict[tuple[str, str], object] = {}


def held(kind: str, key: str, build: Callable[[str], object]) -> object:
    """The worker's own object for a key, built on first use. Workers outlive a stage, so
    what they held for another one is let go first."""
    if (kind, key) not in _HELD:
        let_go()
        _HELD[kind, key] = build(key)
    return _HELD[kind, key]


def let_go() -> None:
    """Free what earlier stages made this worker remember."""
    _HELD.clear()


class Remembered:
    """What a worker has learnt about the words it met lately, ``size`` to twice as many.

    When full, the words become the older half; those met again are taken over from it.
    """

    def __init__(self, learn: Callable[[list[str]], Iterable[bytes]], size: int):
        self.learn, self.size = learn, size
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def of(self, words: list[str]) -> bytes:
        """The values of words one after another."""
        recent = self.recent
        missing = [word for word in set(words) if word not in recent]
        if missing and len(recent) + len(missing) > self.size:
            self.older, self.recent = recent, {}
            recent, missing = self.recent, list(set(words))
        if missing:
            older, new = self.older, []
            for word in missing:
                if word in older:
                    recent[word] = older[word]
                else:
                    new.append(word)
            recent.update(zip(new, self.learn(new), strict=True) if new else ())
        return b"".join(map(recent.__getitem__, words))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs of a block; their earlier values come back after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def boxed(docs: DataFrame, *more: Column) -> DataFrame:
    """The rows of ``docs`` as one struct ``row``, and other columns whose names then clash with none of theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def unboxed(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them replaced."""
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Keep Arrow batches small from now on, so that long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def same(left: Column, right: Column) -> Column:
    """Equality that also holds between two nulls."""
    return left.eqNullSafe(right)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int,
           spread: Sequence[str]) -> DataFrame:
    """Left join a table with one row per ``key`` onto ``rows``, whatever the skew.

    ``size`` is the column of ``groups`` with the key's number of rows and ``total`` the
    number of all rows. At most ``HEAVY_SHARE`` keys have more than one row in
    ``HEAVY_SHARE``; these are broadcast, and their rows are dealt out by ``spread`` in
    the shuffled join, where they match nothing. Keys are strings or binary. The columns
    of ``groups`` besides the key come back in a struct ``found``, null without a match.
    """
    values = F.struct(*[c for c in groups.columns if c != key])
    heavy = F.broadcast(groups.where(F.col(size) > max(total // HEAVY_SHARE, 1))
                        .select(F.col(key).alias("_heavy_key"), values.alias("_heavy")))
    light = (groups.where(F.col(size) <= max(total // HEAVY_SHARE, 1))
             .select(F.col(key).alias("_light_key"), values.alias("_light")))
    seen = rows.join(heavy, F.col(key) == F.col("_heavy_key"), "left")
    dealt = F.when(F.col("_heavy_key").isNull(), F.col(key)).otherwise(
        F.concat(F.lit("heavy "), F.xxhash64(*spread).cast("string")).cast(rows.schema[key].dataType))
    seen = seen.withColumn("_deal", dealt)
    return (seen.join(light, F.col("_deal") == F.col("_light_key"), "left")
            .select(*rows.columns, F.coalesce("_heavy", "_light").alias("found")))


def matched(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """The rows whose key is in ``groups``, as in ``attach`` but without the others.

    Run it under ``FILTER_SETTINGS`` where most rows match nothing. ``rows`` is read twice.
    """
    values = F.struct(*[c for c in groups.columns if c != key]).alias("found")
    limit = max(total // HEAVY_SHARE, 1)
    heavy = F.broadcast(groups.where(F.col(size) > limit).select(key, values))
    light = groups.where(F.col(size) <= limit).select(key, values)
    names = [*rows.columns, "found"]
    return (rows.join(heavy, key).select(*names)
            .unionByName(rows.join(heavy.select(key), key, "left_anti").join(light, key).select(*names)))
