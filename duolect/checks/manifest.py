"""Scans, filters, positions, shards and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from duolect.checks.fixtures import LANGUAGES, VIEW, config, guarded_columns, manifest_view, text_clip
from duolect.checks.registry import check
from duolect.operators import filters, outcomes, shards
from duolect.plans.samples import probe_first_row
from duolect.session import workspace
from duolect.sources.manifest import load_manifest, scan_languages, scan_manifest
from duolect.checks.standins import standin_teachers

_ROW = "row_no, id, lang, dataset, split, tier, audio_path, round(duration_s, 6) AS duration_s"
_KEPT = "lang = 'en' AND duration_s BETWEEN 3.0 AND 150.0"


def _rows(df):
    return df.select("row_no", "id", "lang", "dataset", "split", "tier", "audio_path",
                     F.round("duration_s", 6).alias("duration_s"))


def _as_csv(df, purpose):
    """Write rows in file order as a CSV manifest whose columns are in another order
    than ours, with one more than we know."""
    path = workspace(df.sparkSession, purpose)
    (df.orderBy("row_no").select("text", "duration_s", "audio_path", "id", F.lit("x").alias("note"),
                                 "split", "dataset", "tier", "lang")
     .write.option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path, header=True))
    return path


def _kept(spark, sf):
    return filters.filter_manifest(manifest_view(spark, sf), config())


@check("manifest_scan", f"""WITH {VIEW}
SELECT id, lang, dataset, split, tier, audio_path, round(duration_s, 6) AS duration_s,
       length(text) AS text_len, md5(text) AS text_md5 FROM manifest""")
def manifest_scan(spark, sf):
    rows = scan_manifest(spark, _as_csv(manifest_view(spark, sf), "csv"))
    return rows.select("id", "lang", "dataset", "split", "tier", "audio_path",
                       F.round("duration_s", 6).alias("duration_s"),
                       F.length("text").alias("text_len"), F.md5("text").alias("text_md5"))


@check("manifest_load", f"""WITH {VIEW}
SELECT row_number() OVER (ORDER BY row_no) - 1 AS idx, id, tier, CAST(NULL AS INTEGER) AS tier_rank,
       md5(text) AS text_md5
FROM manifest WHERE {_KEPT} AND tier IN ('Gold')""")
def manifest_load(spark, sf):
    path = _as_csv(manifest_view(spark, sf), "csv")
    cfg = config(manifests={"en": path}, tiers=("Gold",))
    return load_manifest(spark, cfg).select("idx", "id", "tier", "tier_rank", F.md5("text").alias("text_md5"))


@check("manifest_select", f"WITH {VIEW} SELECT id, lang, round(duration_s, 6) AS duration_s FROM manifest")
def manifest_select(spark, sf):
    view = manifest_view(spark, sf)
    paths = {lang: _as_csv(view.where(F.col("lang") == lang), f"csv-{lang}") for lang in LANGUAGES}
    return scan_languages(spark, paths).select("id", "lang", F.round("duration_s", 6).alias("duration_s"))


@check("filter_lang", f"WITH {VIEW} SELECT {_ROW} FROM manifest WHERE lang = 'en'")
def filter_lang(spark, sf):
    return _rows(filters.filter_lang(manifest_view(spark, sf), "en"))


@check("filter_duration", f"WITH {VIEW} SELECT {_ROW} FROM manifest WHERE duration_s BETWEEN 3.0 AND 150.0")
def filter_duration(spark, sf):
    return _rows(filters.filter_duration(manifest_view(spark, sf), 3.0, 150.0))


@check("filter_tier", f"WITH {VIEW} SELECT {_ROW} FROM manifest WHERE tier IN ('Gold')")
def filter_tier(spark, sf):
    return _rows(filters.filter_tier(manifest_view(spark, sf), "Gold"))


@check("manifest_filtered_count", f"WITH {VIEW} SELECT count(*) AS n_rows FROM manifest WHERE {_KEPT}")
def manifest_filtered_count(spark, sf):
    return outcomes.count_rows(_kept(spark, sf))


_PLACED = f"""{VIEW}, placed AS (
  SELECT *, row_number() OVER (ORDER BY row_no) - 1 AS idx FROM manifest WHERE {_KEPT})"""


@check("shard_round_robin", f"WITH {_PLACED} SELECT row_no, idx, idx % 4 AS shard FROM placed WHERE idx % 4 = 1")
def shard_round_robin(spark, sf):
    placed = shards.assign_shards(shards.with_row_index(_kept(spark, sf)), 4)
    return shards.take_shard(placed, 1, 4).select("row_no", "idx", "shard")


@check("all_shards", f"WITH {_PLACED} SELECT row_no, idx, idx % 8 AS shard FROM placed")
def all_shards(spark, sf):
    placed = shards.assign_shards(shards.with_row_index(_kept(spark, sf)), 8)
    return placed.select("row_no", "idx", "shard")


@check("shard_limit", f"""WITH {_PLACED}, sharded AS (
  SELECT *, idx % 4 AS shard, row_number() OVER (PARTITION BY idx % 4 ORDER BY idx) AS place FROM placed)
SELECT row_no, idx, shard, replace(replace(replace(id, '/', '_'), '\\', '_'), ':', '_') AS sample_id,
       length(text) AS text_len
FROM sharded WHERE place <= 20""")
def shard_limit(spark, sf):
    placed = shards.assign_shards(shards.with_row_index(_kept(spark, sf)), 4)
    return guarded_columns(shards.limit_per_shard(placed, 4, 20)).select(
        "row_no", "idx", "shard", "sample_id", F.length("text").alias("text_len"))


@check("shard_stats", f"""WITH {_PLACED}
SELECT idx % 4 AS shard, count(*) AS shard_size, 4 AS num_shards,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total
FROM placed GROUP BY idx % 4""")
def shard_stats(spark, sf):
    return outcomes.shard_stats(shards.assign_shards(shards.with_row_index(_kept(spark, sf)), 4), 4)


@check("first_row_probe", f"""WITH {_PLACED}
SELECT row_no, id, trim(text) AS src_text FROM placed WHERE idx = 0""")
def first_row_probe(spark, sf):
    rows = guarded_columns(_kept(spark, sf).withColumn("clip", text_clip(F.col("text")))).drop("src_text")
    probed = probe_first_row(rows, config(), standin_teachers(with_asr=True), order="row_no")
    return probed.select("row_no", F.col("raw_id").alias("id"), "src_text")


@check("seeded_shuffle", f"""WITH {VIEW}
SELECT row_no, row_number() OVER (ORDER BY md5('7:' || id || ':' || CAST(row_no AS VARCHAR))) - 1 AS idx
FROM manifest""")
def seeded_shuffle(spark, sf):
    return shards.seeded_shuffle(manifest_view(spark, sf), seed=7).select("row_no", "idx")
