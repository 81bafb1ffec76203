"""Audio clips: listings, whole-file scans and decoding inside tasks."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from functools import reduce
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duolect.config import AUDIO_ROWS, SOURCE_RATE
from duolect.functions.audio import WavClip, load_mono
from duolect.functions.files import clip_shape, entries, read_clip
from duolect.functions.text import MISSING_CLIP, listed_path
from duolect.operators.inference import TEXT_ROWS, infer_map, spread
from duolect.session import materialize

# Entries of a folder that are handed on at a time, and tasks that list folders of one level.
LISTED_ROWS = 4096
MOST_LISTERS = 1024


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder: path, length, and whether it is a folder itself."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            for some in batched(entries(folder), LISTED_ROWS):
                names, sizes, folders = zip(*some, strict=True)
                paths = [f"{folder.rstrip('/')}/{name}" for name in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(folders, pa.bool_())], ["path", "length", "folder"])


def list_clips(spark: SparkSession, root: str, pattern: str = "*.wav") -> DataFrame:
    """``(path, length)`` of the files under a folder whose names match, without reading them.

    Folders are listed by tasks, one level of them after the other; the driver learns
    how many there are and nothing else. A listing is stored, so a lost executor repeats none.
    """
    levels = []
    folders = spark.createDataFrame([(root.removeprefix("file:") if root.startswith("file:/") else root,)], "path string")
    while (count := folders.count()):
        spread_out = folders.repartition(min(count, MOST_LISTERS), "path")
        levels.append(materialize(spread_out.mapInArrow(_listed, "path string, length long, folder boolean"), "listing"))
        folders = levels[-1].where("folder").select("path")
    found = reduce(DataFrame.unionByName, levels).where("not folder")
    shape = "^" + re.escape(pattern).replace(r"\*", "[^/]*").replace(r"\?", "[^/]") + "$"
    return found.where(F.element_at(F.split("path", "/"), -1).rlike(shape)).select(listed_path(F.col("path")).alias("path"), "length")


def scan_clips(spark: SparkSession, root: str, pattern: str = "*.wav") -> DataFrame:
    """``(path, length, content)`` of a folder of clips, each read by the task that has its row.

    A job takes its paths from the manifest and opens each clip in the task that needs
    it (``functions.files.read_clip``).
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, AUDIO_ROWS):
                rows = whole.slice(at, AUDIO_ROWS)
                content = [read_clip(path) for path in rows.column("path").to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(content, pa.binary())], ["path", "length", "content"])

    listed = list_clips(spark, root, pattern)
    return spread(listed, None, "path").mapInArrow(read, "path string, length long, content binary")


def clip_shapes(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``rate``, ``channels``, ``frames`` and ``clip_duration_s`` of each row's clip, of
    which only the header is read; one that cannot be read becomes an error row."""
    def shape(_, row: dict) -> dict:
        rate, channels, frames = clip_shape(row[path])
        return {"rate": rate, "channels": channels, "frames": frames, "clip_duration_s": frames / rate}

    return infer_map(df, shape, [path], "rate int, channels int, frames bigint, clip_duration_s double", chunk_rows=TEXT_ROWS)


def decode_clips(df: DataFrame, target_rate: int | None = SOURCE_RATE,
                 content: str = "content") -> DataFrame:
    """Decode PCM WAV bytes to mono float samples at ``target_rate`` (None keeps the
    clip's own). The bytes are replaced by samples; a bad clip becomes an error row."""

    def decode(_, row: dict) -> dict:
        if row[content] is None:
            raise FileNotFoundError(MISSING_CLIP + "no content")
        clip = WavClip(io.BytesIO(row[content]))
        rate = target_rate or clip.rate
        samples = load_mono(clip, rate)
        return {"source_rate": clip.rate, "channels": clip.channels, "samples": samples,
                "sample_rate": rate, "n_samples": samples.size}

    return infer_map(df, decode, inputs=[content], drop=[content], outputs="""
        source_rate int, channels int, sample_rate int, n_samples bigint, samples array<float>""")
