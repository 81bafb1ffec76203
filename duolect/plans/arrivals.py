"""Growing manifests: every file that arrives in a folder becomes a job, once."""

from __future__ import annotations

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession

from duolect.config import JobConfig
from duolect.operators.inference import Teachers
from duolect.plans.build import run_job
from duolect.plans.samples import sample_columns, select_rows
from duolect.sources.manifest import load_manifest


def run_arrivals(spark: SparkSession, cfg: JobConfig, teachers: Teachers, folder: str, checkpoint: str,
                 files_per_batch: int = 64, profile: ResourceProfile | None = None) -> None:
    """Build the samples of the manifest files in a folder that were not built before.

    A file stream notes in ``checkpoint`` which files it has seen and hands them on in
    batches of ``files_per_batch``; it ends when there are no more, and a later call
    takes up what has arrived since. Each batch is a job under a name made of the output
    folder's own stream and the batch's number. A batch that died is run again under its
    name and leaves out what its first try committed, so each of its rows is committed once.
    Files must not change after they arrive. Their columns are found by name, as in
    ``scan_manifest``, file by file; sharding, limits and positions are those within a batch.
    """
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    arrived = (names.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.csv").load(folder)
               .select("path"))

    def build(found: DataFrame, number: int) -> None:
        paths = sorted(row.path for row in found.distinct().collect())  # at most files_per_batch names
        if paths:
            rows = sample_columns(select_rows(load_manifest(spark, cfg, paths), cfg), cfg)
            run_job(spark, cfg, teachers, rows, profile=profile, name=f"{folder.rstrip('/')}#{number}")

    (arrived.writeStream.foreachBatch(build).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
