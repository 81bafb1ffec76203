"""Guards turn a row into an error row; the first one that fails is reported."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duolect.functions import text as T
from duolect.functions.arrays import cut_bounds_valid

# Fixed value: the message for a cut outside its clip.
BAD_CUT = "Invalid start or end times"

ERROR_COLUMNS = ("error_kind", "error_msg", "error")


class Guard(NamedTuple):
    fails: Column
    kind: str
    message: Column


def clip_exists(present: Column, path: Column) -> Guard:
    return Guard(~F.coalesce(present, F.lit(False)), "FileNotFoundError",
                 F.concat(F.lit(T.MISSING_CLIP), path))


def source_text_present(text: Column, sample_id: Column, text_column: str = "text") -> Guard:
    return Guard(T.is_blank(text), "ValueError", T.empty_source_message(sample_id, text_column))


def lang_pair_known(src: Column, tgt: Column, text: Column, languages: Iterable[str]) -> Guard:
    """Unknown pairs fail only where there is text to translate."""
    fails = ~T.is_blank(text) & ~T.lang_pair_supported(src, tgt, languages)
    return Guard(fails, "ValueError", F.concat(F.lit(T.BAD_PAIR), src, F.lit("->"), tgt))


def target_text_present(text: Column) -> Guard:
    return Guard(T.is_blank(text), "ValueError", F.lit(T.EMPTY_TARGET))


def duration_matches(measured: Column, declared: Column, tolerance: float = 0.1) -> Guard:
    fails = F.coalesce(F.abs(measured - declared) > tolerance * declared, F.lit(False))
    return Guard(fails, "ValueError", F.concat(
        F.lit("Duration mismatch: measured "), F.format_string("%.3f", measured),
        F.lit("s, manifest "), F.format_string("%.3f", declared), F.lit("s")))


def cut_bounds(start_s: Column, end_s: Column, rate: Column, n_samples: Column) -> Guard:
    return Guard(~cut_bounds_valid(start_s, end_s, rate, n_samples), "ValueError",
                 F.lit(BAD_CUT))


def apply_guards(df: DataFrame, *guards: Guard) -> DataFrame:
    """Add ``status`` and the error columns; rows already in error keep theirs."""
    first = F.coalesce(*[
        F.when(g.fails, F.struct(F.lit(g.kind).alias("kind"), g.message.alias("msg")))
        for g in guards])
    found = {"error_kind": F.col("_first.kind"), "error_msg": F.col("_first.msg"),
             "error": T.error_repr(F.col("_first.kind"), F.col("_first.msg"))}
    if "error_kind" in df.columns:
        earlier = F.col("error_kind").isNotNull()
        found = {c: F.when(earlier, F.col(c)).otherwise(new) for c, new in found.items()}
    return (df.withColumn("_first", first).withColumns(found).drop("_first")
              .withColumn("status", F.when(F.col("error_kind").isNull(), "ok").otherwise("error")))
