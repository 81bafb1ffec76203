"""Array columns: casts, batch axes, channel means and cuts, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_float_vector(values: Column) -> Column:
    return values.cast("array<float>")


def as_token_matrix(values: Column) -> Column:
    return values.cast("array<array<bigint>>")


def squeeze_batch(values: Column) -> Column:
    """Drop a leading axis of size one; any other size is an error downstream."""
    return F.when(F.size(values) == 1, F.element_at(values, 1))


def _mean_of(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return total / F.size(values)


def mixdown_frames(frames: Column) -> Column:
    """Mean over channels of ``[time][channel]`` samples."""
    return F.transform(frames, _mean_of)


def mixdown_channels(channels: Column) -> Column:
    """Mean over channels of ``[channel][time]`` samples."""
    first = F.transform(F.element_at(channels, 1), lambda x: x.cast("double"))
    rest = F.slice(channels, 2, F.greatest(F.size(channels) - 1, F.lit(0)))
    total = F.aggregate(rest, first, lambda acc, ch: F.zip_with(acc, ch, lambda a, b: a + b.cast("double")))
    return F.transform(total, lambda x: x / F.size(channels))


def cut_start(start_s: Column, rate: Column) -> Column:
    return (start_s * rate).cast("bigint")


def cut_bounds_valid(start_s: Column, end_s: Column, rate: Column, n_samples: Column) -> Column:
    """Non-negative start, end within the clip, start before end, in whole samples."""
    start, end = cut_start(start_s, rate), cut_start(end_s, rate)
    return F.coalesce((start >= 0) & (end <= n_samples) & (start < end), F.lit(False))


def cut_samples(samples: Column, start_s: Column, end_s: Column, rate: Column) -> Column:
    """Samples ``[int(start*rate), int(end*rate))``; null where the bounds are invalid."""
    start, end = cut_start(start_s, rate), cut_start(end_s, rate)
    valid = cut_bounds_valid(start_s, end_s, rate, F.size(samples))
    return F.when(valid, F.slice(samples, (start + 1).cast("int"), (end - start).cast("int")))


def plain_float(value: Column) -> Column:
    """A double in positional notation with at least one decimal: ``1.0``, ``0.0005``."""
    digits = F.regexp_replace(value.cast("decimal(38,18)").cast("string"), "0+$", "")
    return F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)


def cut_name(path: Column, start_s: Column, end_s: Column) -> Column:
    """``<base>_cut_<start>-<end>.wav`` beside the input."""
    base = F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", "")
    return F.concat(base, F.lit("_cut_"), plain_float(start_s), F.lit("-"), plain_float(end_s),
                    F.lit(".wav"))
