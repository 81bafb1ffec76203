"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolect.llm.common import attach
from duolect.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Nodes of ``links`` (a, b: long) with the smallest node they are linked to: node, root.

    Each round hangs every node's larger neighbours, then its smaller ones, on the
    smallest of them, and stores the links; it ends when a round changes nothing, with
    every node hung on its root. The number of rounds grows with the logarithm of the
    longest path. Minima are combined before the shuffle, and a node with very many
    links is dealt out (see ``attach``). Loops and repeats do no harm.
    """
    now = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                      "links")
    before = None
    while (mark := now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()) != before:
        before = mark
        now = materialize(_small_star(_large_star(now, 2 * mark[0]), 2 * mark[0]), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _with_least(links: DataFrame, total: int) -> DataFrame:
    """Each link (a, b) with ``low``, the least of a and all its neighbours b."""
    least = links.groupBy(F.col("a").cast("string").alias("key")).agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("size"))
    keyed = links.withColumn("key", F.col("a").cast("string"))
    return attach(keyed, least, "key", "size", total, ["b"]).select("a", "b", F.least("a", "found.low").alias("low"))


def _large_star(links: DataFrame, total: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both, total).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame, total: int) -> DataFrame:
    seen = _with_least(links, total)
    hung = seen.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.unionByName(seen.select("a", F.col("low").alias("b"))).distinct()
