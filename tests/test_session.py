import os

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from duolect.config import AUDIO_ROWS
from duolect.session import materialize


def _group_rows(df):
    files = [pq.ParquetFile(path.removeprefix("file:").replace("///", "/")).metadata for path in df.inputFiles()]
    return [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]


def test_stored_clips_are_read_a_few_rows_at_a_time(spark):
    rows = spark.range(0, 500, 1, 2).withColumn("clip", F.repeat(F.lit("a"), 100_000).cast("binary"))
    stored = materialize(rows, "clips")
    sizes = _group_rows(stored)
    assert sum(sizes) == 500 and max(sizes) <= AUDIO_ROWS
    assert stored.agg(F.sum(F.octet_length("clip"))).first()[0] == 500 * 100_000
    assert max(_group_rows(materialize(rows.drop("clip"), "plain"))) == 250


def test_digests_are_stored_in_groups_of_ordinary_size(spark):
    rows = spark.range(0, 500, 1, 2).withColumn("key", F.unhex(F.md5(F.col("id").cast("string"))))
    stored = materialize(rows, "digests", digests=["key"])
    assert _group_rows(stored) == [250, 250]
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    both = rows.withColumn("clip", F.repeat(F.lit("a"), 10_000).cast("binary"))
    assert max(_group_rows(materialize(both, "clips", digests=["key"]))) <= AUDIO_ROWS


def _codecs(df):
    files = [pq.ParquetFile(path.removeprefix("file:").replace("///", "/")).metadata for path in df.inputFiles()]
    return {m.row_group(0).column(i).compression for m in files for i in range(m.num_columns)}


def test_clips_are_stored_with_zstd(spark):
    """Noise in 16 bits, as quiet as speech often is: hardly smaller by the default codec, and whole when read back."""
    noise = np.random.default_rng(1).normal(0, 200, (64, 24_000)).astype("<i2")
    rows = spark.createDataFrame([(n, bytearray(x.tobytes())) for n, x in enumerate(noise)], "id long, clip binary")
    stored = materialize(rows, "clips")
    assert _codecs(stored) == {"ZSTD"} and _codecs(materialize(rows.drop("clip"), "plain")) == {"SNAPPY"}
    assert {r.id: bytes(r.clip) for r in stored.collect()} == {n: x.tobytes() for n, x in enumerate(noise)}
    size = sum(os.path.getsize(path.removeprefix("file:").replace("///", "/")) for path in stored.inputFiles())
    assert size < 0.8 * noise.nbytes
