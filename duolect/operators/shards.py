"""Positions in file order, round-robin shards and per-shard limits.

A dense position needs no global sort: rows fall into fixed-width buckets of the
order column, buckets are counted, and running sums over a tree of buckets turn the counts
into offsets. Buckets and the nodes' children are bounded in number, so no window sorts
more than that however skewed the rows or sparse their order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 12  # rows per bucket, as a power of two
NODE_BITS = 18  # children per node of the tree over the buckets: these are counts, so more fit a task
ORDER_BITS = 64


def _before(partition: Sequence[str], order: Sequence[str], value: str) -> Column:
    window = Window.partitionBy(*partition).orderBy(*order)
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _offsets(counts: DataFrame, seg: list[str], restart: bool, bits: int) -> DataFrame:
    """The number of rows before each bucket (``_at``, from 0 to below 2 to the ``bits``), by a tree of
    sums: nodes are counted upwards and their places handed down, each among its parent's children."""
    levels = [counts]
    for _ in range(-(-bits // NODE_BITS)):
        parent = F.shiftright("_at", NODE_BITS).alias("_at")
        levels.append(levels[-1].groupBy(*seg, parent).agg(F.sum("_n").alias("_n")))
    base = F.lit(0).cast("bigint")
    placed = levels.pop()  # one node for each segment
    if seg and not restart:
        for last in range(len(seg), 0, -1):
            # segments before this one, among those alike in the columns before the last
            sizes = placed.groupBy(*seg[:last]).agg(F.sum("_n").alias("_n"))
            before = sizes.select(*seg[:last], _before(seg[:last - 1], [seg[last - 1]], "_n").alias(f"_before_{last}"))
            placed = placed.join(before, seg[:last], "left")
            base = base + F.col(f"_before_{last}")
    placed = placed.select(*seg, F.col("_at").alias("_parent"), base.alias("_base"))
    for nodes in reversed(levels):
        rising = nodes.withColumn("_parent", F.shiftright("_at", NODE_BITS))
        inside = rising.withColumn("_inside", _before([*seg, "_parent"], ["_at"], "_n"))
        placed = (inside.join(placed, [*seg, "_parent"], "left")
                  .select(*seg, F.col("_at").alias("_parent"), (F.col("_base") + F.col("_inside")).alias("_base")))
    return placed.select(*seg, F.col("_parent").alias("_at"), F.col("_base").alias("_offset"))


def with_row_index(df: DataFrame, order: str = "row_no", segment: Sequence[str] = (),
                   restart: bool = False, bucket: Column | None = None,
                   name: str = "idx", bits: int = ORDER_BITS - BUCKET_BITS) -> DataFrame:
    """Add the 0-based position of each row by (``segment``, ``order``), or by
    ``order`` within its segment if ``restart`` is set.

    ``order`` is unique within a segment. ``bucket`` maps it to integers from 0 to below 2 to the
    ``bits`` that rise with it and gather few rows each; by default an integer order is cut into
    ranges. Without ``restart`` one window has no partition, which gets a row for each value of
    the first segment column, a manifest's file say; without segments there is none.
    """
    seg = list(segment)
    # counted from the least order there is, so that buckets are not negative
    width = F.shiftright(F.col(order), BUCKET_BITS) + (1 << (bits - 1)) if bucket is None else bucket
    rows = df.withColumn("_at", width.cast("bigint"))
    counts = rows.groupBy(*seg, "_at").agg(F.count(F.lit(1)).alias("_n"))
    local = F.row_number().over(Window.partitionBy(*seg, "_at").orderBy(order)) - 1
    # every bucket has its counts; left joins keep the row side from being broadcast
    # and let the uses of the counts share one exchange
    return (rows.withColumn("_local", local).join(_offsets(counts, seg, restart, bits), [*seg, "_at"], "left")
            .withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint"))
            .select(*df.columns, name))


def assign_shards(df: DataFrame, num_shards: int) -> DataFrame:
    """Round-robin shard of each position; one shard or fewer puts all rows in shard 0."""
    count = max(num_shards, 1)
    return df.withColumn("shard", F.pmod(F.col("idx"), F.lit(count)).cast("int"))


def take_shard(df: DataFrame, shard_idx: int, num_shards: int) -> DataFrame:
    if not 0 <= shard_idx < max(num_shards, 1):
        raise ValueError(f"shard_idx {shard_idx} is outside 0..{num_shards - 1}")
    return df.where(F.col("shard") == shard_idx)


def limit_per_shard(df: DataFrame, num_shards: int, max_samples: int) -> DataFrame:
    """First ``max_samples`` rows of every shard (0 = all). Positions are dense and
    dealt out in turn, so these are exactly the first ``max_samples * num_shards``."""
    if max_samples <= 0:
        return df
    return df.where(F.col("idx") < max_samples * max(num_shards, 1))


def seeded_shuffle(df: DataFrame, seed: int, key: str = "id", order: str = "row_no",
                   name: str = "idx") -> DataFrame:
    """Positions in an order that depends only on the seed and the row, so a rerun
    repeats it; the row's own number in the hash keeps repeated keys apart."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key), F.col(order).cast("string")))
    hashed = df.withColumn("_digest", digest)
    bucket = F.conv(F.substring("_digest", 1, 6), 16, 10).cast("bigint")
    return with_row_index(hashed, "_digest", bucket=bucket, name=name, bits=24).drop("_digest")


def first_row(df: DataFrame, order: str = "row_no") -> DataFrame:
    """The first row by order: a top-1 per task, then of those, never a full sort."""
    return df.orderBy(order).limit(1)
