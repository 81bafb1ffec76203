"""Session helpers: a shared work folder and shipping this package to executors."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import BinaryType

from duolect.config import AUDIO_ROWS
from duolect.functions.shared import remove

_SHIPPED: set[str] = set()
_WITHIN: ContextVar[str | None] = ContextVar("_WITHIN", default=None)


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session that names none gets a temporary folder; on a cluster a
    machine-local path would be invisible to the other executors, so it is refused.
    Within ``passing`` the path is under the folder that is deleted at its end.
    """
    root = _WITHIN.get() or spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="duolect-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def passing(spark: SparkSession, purpose: str) -> Iterator[None]:
    """What ``workspace`` names inside is deleted at the end, also after a failure. So nothing that is
    still to be read then, such as a frame that is handed out, may rest on it."""
    path = workspace(spark, purpose)
    before = _WITHIN.set(path)
    try:
        yield
    finally:
        _WITHIN.reset(before)
        remove(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Put this package on the executors' import path, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="duolect-ship-")) / package.name
    archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def writer(df: DataFrame, digests: Sequence[str] = ()) -> DataFrameWriter:
    """A frame's writer. Rows with clips go to row groups of few rows: Spark reads up to 4096 rows
    of a group at once, whatever their size, and the size of a group is known only as compressed.
    They are stored with zstd: clips are most of what a job stores, and Spark's default codec gains less.
    Binary columns are taken for clips unless named in ``digests``: those are a few bytes long,
    and a group for every few of them would be mostly footer."""
    clips = [f.name for f in df.schema if isinstance(f.dataType, BinaryType) and f.name not in digests]
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in clips}
    return df.write.options(**{"parquet.block.row.count.limit": AUDIO_ROWS, "compression": "zstd"} | plain) if clips else df.write


def materialize(df: DataFrame, purpose: str, *partition_by: str, digests: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps start from
    stored rows, so a lost executor never sends them back through this lineage. Binary
    columns that hold no clips are named in ``digests`` (see ``writer``)."""
    return store(df, workspace(df.sparkSession, purpose), *partition_by, digests=digests)


def store(df: DataFrame, path: str, *partition_by: str, digests: Sequence[str] = ()) -> DataFrame:
    """``materialize`` at a path of the caller's, who can delete it."""
    writer(df, digests).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
