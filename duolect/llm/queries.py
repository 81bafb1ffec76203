"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duolect.llm import exact_dedup as exact
from duolect.llm import pieces as sentencepieces
from duolect.llm import hard_negatives, language_id, line_dedup, packing, quality, reduced_packing, runs, simhash, syncmers, toxicity, warc
from duolect.llm.common import table
from duolect.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


@_add("op1_exact_dedup", """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents")).drop("copies")


@_add("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_add("op3_line_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rest.select("doc_id", "text", "removed")


@_add("op4_syncmers")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_edits(table(spark, sf_dir, "documents"))


@_add("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_add("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, end_id=1)


@_add("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


@_add("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "chunk", "chunks", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                          F.crc32("ids").alias("ids_crc32"), "restored")


@_add("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_add("op10_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS largest FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM m""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def adjusted(embeddings: DataFrame) -> DataFrame:
    """Rows as the miner takes them: whole-number vectors, and some labels moved on to another."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), hard_negatives.quantised("embedding").alias("vector"))


@_add("op11_hard_negatives", """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS other_id, a.label = e.label AS same,
         CAST(list_dot_product(a.q, e.q) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(adjusted(table(spark, sf_dir, "embeddings")))


@_add("op12_reduced_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return reduced_packing.pack(table(spark, sf_dir, "documents"), path, end_id=1)


@_add("op13_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.summarised(runs.periodic_runs(table(spark, sf_dir, "documents"), runs.planted))
