"""Manifest filters: rows they drop leave no trace in the ledger."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolect.config import JobConfig


def filter_lang(df: DataFrame, lang: str) -> DataFrame:
    return df.where(F.col("lang") == lang)


def filter_duration(df: DataFrame, low: float = 0.0, high: float = 1e9) -> DataFrame:
    """Keep durations within the closed range, if the manifest has durations at all."""
    if "duration_s" not in df.columns:
        return df
    return df.where(F.col("duration_s").between(low, high))


def filter_tier(df: DataFrame, tiers: str | Iterable[str] | None) -> DataFrame:
    """Keep listed tiers, if tiers are configured and the manifest has the column."""
    if tiers is None or "tier" not in df.columns:
        return df
    allowed = [tiers] if isinstance(tiers, str) else list(tiers)
    return df.where(F.col("tier").isin(allowed))


def filter_manifest(df: DataFrame, cfg: JobConfig) -> DataFrame:
    kept = filter_duration(filter_lang(df, cfg.lang), cfg.min_duration, cfg.max_duration)
    return filter_tier(kept, cfg.tiers)


def within_duration_tolerance(df: DataFrame, tolerance: float = 0.1,
                              measured: str = "measured_s") -> DataFrame:
    """Keep rows whose measured duration is within a fraction of the manifest's."""
    gap = F.abs(F.col(measured) - F.col("duration_s"))
    return df.where(gap <= tolerance * F.col("duration_s"))
