"""Joins, resume, summaries and the tables a run writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from duolect.checks.fixtures import (DATA_ROOT, DIRTY, OUTCOMES, SHARDS, config, dirty_outcomes,
                                     manifest_dirty, sql_resolve, sql_sanitize, table)
from duolect.checks.registry import check
from duolect.functions import text as T
from duolect.operators import attach, outcomes, resume
from duolect.plans.build import to_outcome
from duolect.session import materialize, workspace
from duolect.sinks import tables
from duolect.sources.done import done_keys, read_dataset, read_outcomes


def _keyed(df):
    return df.withColumn("sample_id", T.sanitize_id(F.col("id")))


def _earlier_runs(spark, sf):
    """A committed run that finished the done rows, and one that never committed."""
    cfg = config(workspace(spark, "earlier"))
    rows = (_keyed(manifest_dirty(spark, sf)).withColumnRenamed("id", "raw_id")
            .withColumns({"direction": F.lit(cfg.direction), "idx": F.col("row_no"),
                          "status": F.when(F.col("done"), "ok").otherwise("error")}))
    tables.write_outcomes(to_outcome(rows, "run-first"), cfg, "run-first")
    tables.commit_run(spark, cfg, "run-first")
    tables.write_outcomes(to_outcome(rows.withColumn("status", F.lit("ok")), "run-killed"), cfg, "run-killed")
    return cfg


@check("done_scan", f"WITH {DIRTY} SELECT {sql_sanitize('id')} AS sample_id FROM dirty WHERE done")
def done_scan(spark, sf):
    return done_keys(spark, _earlier_runs(spark, sf))


@check("commit_marker", f"""WITH {DIRTY}
SELECT 'run-first' AS run_id, {sql_sanitize('id')} AS sample_id, CASE WHEN done THEN 'ok' ELSE 'error' END
  AS status FROM dirty""")
def commit_marker(spark, sf):
    return read_outcomes(spark, _earlier_runs(spark, sf)).select("run_id", "sample_id", "status")


@check("jobs_at_once", f"""WITH {DIRTY}, keyed AS (SELECT *, {sql_sanitize('id')} AS sample_id FROM dirty)
SELECT sample_id, 'run-first' AS run_id FROM keyed WHERE done
UNION ALL SELECT sample_id, 'run-rival' FROM keyed WHERE sample_id NOT IN (SELECT sample_id FROM keyed WHERE done)""")
def jobs_at_once(spark, sf):
    """A second job planned before the first one's commit, and committed after it: keys of both are the first's."""
    cfg = _earlier_runs(spark, sf)
    rows = (_keyed(manifest_dirty(spark, sf)).withColumnRenamed("id", "raw_id")
            .withColumns({"direction": F.lit(cfg.direction), "idx": F.col("row_no"), "status": F.lit("ok")}))
    tables.write_outcomes(to_outcome(rows, "run-rival"), cfg, "run-rival")
    tables.commit_run(spark, cfg, "run-rival", job="run-rival", base=[])
    return read_dataset(spark, cfg).select("sample_id", "run_id")


@check("resume_pending", f"""WITH {DIRTY}, keyed AS (SELECT *, {sql_sanitize('id')} AS sample_id FROM dirty)
SELECT row_no, sample_id FROM keyed
WHERE sample_id NOT IN (SELECT sample_id FROM keyed WHERE done)""")
def resume_pending(spark, sf):
    rows = _keyed(manifest_dirty(spark, sf))
    return resume.drop_done(rows, rows.where("done")).select("row_no", "sample_id")


@check("resume_flagged", f"""WITH {DIRTY}, keyed AS (SELECT *, {sql_sanitize('id')} AS sample_id FROM dirty)
SELECT row_no, sample_id IN (SELECT sample_id FROM keyed WHERE done) AS done FROM keyed""")
def resume_flagged(spark, sf):
    rows = _keyed(manifest_dirty(spark, sf))
    return resume.flag_done(rows.drop("done"), rows.where("done")).select("row_no", "done")


@check("rank_within_key", f"""WITH {DIRTY}
SELECT row_no, row_number() OVER (PARTITION BY dataset, lang ORDER BY row_no) - 1 AS rank FROM dirty""")
def rank_within_key(spark, sf):
    return resume.rank_within_key(manifest_dirty(spark, sf), ("dataset", "lang"), "row_no").select(
        "row_no", "rank")


@check("first_success_wins", f"WITH {OUTCOMES} SELECT row_no, raw_id, sample_id, status, error FROM outcomes")
def first_success_wins(spark, sf):
    return dirty_outcomes(spark, sf).select("row_no", "raw_id", "sample_id", "status", "error")


@check("attach_clip", f"""WITH {DIRTY}
SELECT row_no, {sql_resolve('audio_path')} AS resolved_path,
       CASE WHEN present THEN length(spoken) END AS clip_bytes FROM dirty""")
def attach_clip(spark, sf):
    rows = manifest_dirty(spark, sf).withColumn("resolved_path", T.resolve_path(F.col("audio_path"), DATA_ROOT))
    listing = rows.where("present").select(
        F.concat(F.lit("file:"), "resolved_path").alias("path"), F.length("spoken").alias("length"))
    return attach.attach_clip(rows.drop("present"), listing).select("row_no", "resolved_path", "clip_bytes")


@check("attach_sidecar", f"""WITH {DIRTY}
SELECT row_no, len(e.embedding) AS dims, e.label AS cluster
FROM dirty LEFT JOIN embeddings e ON e.vec_id = dirty.row_no""")
def attach_sidecar(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "row_no")
    rows = attach.attach_sidecar(manifest_dirty(spark, sf), vectors, "row_no",
                                 {"embedding": "spk", "label": "cluster"})
    return rows.select("row_no", F.when(F.col("spk").isNotNull(), F.size("spk")).alias("dims"), "cluster")


@check("run_summary", f"""WITH {OUTCOMES}
SELECT shard, count(*) FILTER (status <> 'error') AS processed,
       count(*) FILTER (status = 'error') AS failed FROM outcomes GROUP BY shard""")
def run_summary(spark, sf):
    return outcomes.run_summary(dirty_outcomes(spark, sf))


@check("run_status", f"""WITH {OUTCOMES}
SELECT coalesce(bool_or(failed), false) AS any_failed,
       min(CASE WHEN failed THEN shard END) AS first_failed_shard
FROM (SELECT shard, count(*) FILTER (error LIKE 'FileNotFound%') > 3 AS failed FROM outcomes GROUP BY shard)""")
def run_status(spark, sf):
    per_shard = dirty_outcomes(spark, sf).groupBy("shard").agg(
        (F.count_if(F.col("error_kind") == "FileNotFoundError") > 3).alias("failed"))
    return outcomes.run_status(per_shard)


def _summarised(spark, sf):
    return outcomes.union_outcomes(dirty_outcomes(spark, sf).withColumns({
        "src_duration_s": F.round("duration_s", 6), "tgt_duration_s": F.lit(1.5),
        "out_dir": T.output_key(F.col("direction"), F.col("sample_id"))}))


_SUMMARY = f"""SELECT CASE status WHEN 'error' THEN raw_id ELSE sample_id END AS id,
       CASE status WHEN 'ok' THEN resolved_path ELSE audio_path END AS audio_path,
       CASE status WHEN 'ok' THEN 'en' END AS src_lang, CASE status WHEN 'ok' THEN 'fr' END AS tgt_lang,
       CASE status WHEN 'ok' THEN md5(src_text) END AS src_text,
       CASE status WHEN 'ok' THEN md5(tgt_text) END AS tgt_text,
       CASE status WHEN 'ok' THEN round(duration_s, 6) END AS src_duration_s,
       CASE status WHEN 'ok' THEN CAST(1.5 AS DOUBLE) END AS tgt_duration_s,
       CASE status WHEN 'error' THEN 'error: ' || error ELSE status END AS status,
       CASE status WHEN 'ok' THEN 'data/parallel/enfr/' || sample_id END AS out_dir
FROM outcomes"""


def _digested(df):
    return df.withColumns({"src_text": F.md5("src_text"), "tgt_text": F.md5("tgt_text")})


@check("union_outcomes", f"WITH {OUTCOMES} {_SUMMARY}")
def union_outcomes(spark, sf):
    return _digested(_summarised(spark, sf))


@check("debug_summary", f"WITH {OUTCOMES} {_SUMMARY}")
def debug_summary(spark, sf):
    cfg = config(workspace(spark, "summary"), debug_manifest="given")
    tables.write_debug_summary(_summarised(spark, sf), cfg)
    rows = spark.read.csv(tables.summary_path(cfg), header=True, multiLine=True, escape='"')
    numbers = {c: F.col(c).cast("double") for c in ("src_duration_s", "tgt_duration_s")}
    return _digested(rows.withColumns(numbers))


@check("union_shards", f"WITH {OUTCOMES} SELECT row_no, shard, status FROM outcomes")
def union_shards(spark, sf):
    settled = materialize(dirty_outcomes(spark, sf).select("row_no", "shard", "status"), "shards")
    return outcomes.union_shards([settled.where(F.col("shard") == i) for i in range(SHARDS)])


@check("error_ledger", f"""WITH {OUTCOMES}
SELECT raw_id || '|' || error AS line, lang, direction, shard FROM outcomes WHERE status = 'error'""")
def error_ledger(spark, sf):
    cfg = config(workspace(spark, "ledger"))
    tables.write_errors(dirty_outcomes(spark, sf), cfg, "run-1")
    tables.write_errors(dirty_outcomes(spark, sf), cfg, "run-2")  # never committed: not to be read
    tables.commit_run(spark, cfg, "run-1")
    rows = tables.read_errors(spark, cfg)
    return rows.select(F.concat_ws("|", "raw_id", "error").alias("line"), "lang", "direction", "shard")


@check("split_layout", f"""WITH {OUTCOMES}
SELECT 'tokens' AS layout, direction AS part, sample_id, length(tgt_text) AS n_values FROM outcomes
WHERE status = 'ok'
UNION ALL SELECT 'speakers', 'en', sample_id, 1 FROM outcomes WHERE status = 'ok'""")
def split_layout(spark, sf):
    cfg = config(workspace(spark, "split"))
    book = F.sequence(F.lit(1), F.length("tgt_text")).cast("array<bigint>")
    rows = dirty_outcomes(spark, sf).withColumns({
        "tokens": F.when(F.length("tgt_text") > 0, F.array(book)),
        "spk": F.array(F.lit(1.0)).cast("array<float>")})
    rows = materialize(rows.select("direction", "src_lang", "sample_id", "tokens", "spk", "status"), "rows")
    tables.write_split_layout(*outcomes.split_layout(rows), cfg)
    tokens = spark.read.parquet(f"{cfg.output_root}/tokens").select(
        F.lit("tokens").alias("layout"), F.col("direction").alias("part"), "sample_id",
        F.size(F.element_at("tokens", 1)).alias("n_values"))
    speakers = spark.read.parquet(f"{cfg.output_root}/speakers").select(
        F.lit("speakers").alias("layout"), F.col("src_lang").alias("part"), "sample_id",
        F.size("spk").alias("n_values"))
    return tokens.unionByName(speakers)
