"""All shards one after another, each its own committed run.

Shards are not processes here: every shard is a job over the whole cluster. Running
them in turn only sets how much work one interruption can lose.
"""

from __future__ import annotations

import logging
from dataclasses import replace

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duolect.config import JobConfig
from duolect.operators.inference import Teachers
from duolect.operators.outcomes import run_status
from duolect.plans.build import run_job
from duolect.plans.samples import manifest_samples
from duolect.session import materialize


def run_shards(spark: SparkSession, cfg: JobConfig, teachers: Teachers,
               profile: ResourceProfile | None = None) -> DataFrame:
    """Run every shard, keep going past one that fails, and report ``(any_failed,
    first_failed_shard)``. The manifest is read and dealt out once for all of them."""
    samples = materialize(manifest_samples(spark, replace(cfg, shard_idx=None)), "samples")
    failed = []
    for shard in range(max(cfg.num_shards, 1)):
        try:
            run_job(spark, replace(cfg, shard_idx=shard), teachers,
                    samples.where(F.col("shard") == shard), profile=profile)
            failed.append((shard, False))
        except Exception:
            logging.exception("shard %d failed", shard)
            failed.append((shard, True))
    return run_status(spark.createDataFrame(failed, "shard int, failed boolean"))
