"""Exact deduplication: a stream over digests with keyed state on disk and no expiry.

A scan reduces each document to its digest, identifier, length and locator. A stream
groups these by digest; its RocksDB state keeps, for every digest ever seen, the
document that stays, where its content lies, and the number of rows. Documents that
hit a digest seen before are then compared with the retained text byte for byte.

Everything is a DataFrame operation; the state store spills to disk by itself, and
the checkpoint in the shared folder outlives a lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duolect.llm.common import FILTER_SETTINGS, SALT_ROWS, SPACES, attach, boxed, same, settings, unboxed, whole
from duolect.session import materialize, workspace

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # or each of many partitions takes megabytes at once
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
}


def squeezed(text: str | Column) -> Column:
    """The text without white space: what equality of texts is decided on."""
    return F.translate(whole(text), SPACES, "")


def text_digest(text: str | Column) -> Column:
    return F.sha2(squeezed(text), 256)


def retain(spark: SparkSession, path: str, schema, checkpoint: str,
           bytes_per_batch: int = 64 << 30, files_per_batch: int | None = None) -> DataFrame:
    """Stream the digest rows under ``path`` into the keyed state at ``checkpoint``.

    Returns the state as a table: digest, best (-length, doc_id, locator), size. A
    checkpoint used before goes on from where it stopped: only new files are read.
    """
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch)
    if files_per_batch is not None:
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    grouped = reader.parquet(path).groupBy("digest").agg(
        F.min(F.struct((-F.col("length")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"),
                       "doc_id", "locator")).alias("best"),
        F.count(F.lit(1)).alias("size"))
    with settings(spark, STATE_SETTINGS):
        query = (grouped.writeStream.format("noop").outputMode("update")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        return materialize(state.select("key.*", "value.*").toDF("digest", "best", "size"), "dedup-state")


def exact_dedup(docs: DataFrame, digest: Column | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, copies.

    Texts are equal when they are the same after deleting white space; null counts as
    empty, and all texts without other characters are equal. Of equal texts the one
    with the most code points stays, then the smallest doc_id, a null id last. Rows
    that repeat both id and text are one document: they give one row, ``copies`` says
    how many there are, and group_size counts each. An empty table gives no rows.
    Other columns are not read.

    ``digest`` replaces SHA-256; any function of the text will do, as texts that share
    a digest but not their bytes are told apart.
    """
    spark = docs.sparkSession
    digest = text_digest("text") if digest is None else digest
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.input_file_name().alias("locator"))
    path = workspace(spark, "dedup-digests")
    texts.select("doc_id", digest.alias("digest"), F.length(whole("text")).cast("long").alias("length"), "locator").write.parquet(path)
    seen = spark.read.parquet(path)
    total = seen.count()
    if total == 0:
        one = F.lit(1).cast("long")
        return _shape(seen.select("doc_id", "digest", F.col("doc_id").alias("keep_id"), one.alias("size"), one.alias("copies")))
    state = retain(spark, path, seen.schema, workspace(spark, "dedup-checkpoint"), files_per_batch=files_per_batch)
    rows = seen.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    rows = attach(rows, state.where("size > 1").select("digest", F.col("best.doc_id").alias("keep_id"), "size"),
                  "digest", "size", total, ["doc_id"])
    rows = materialize(rows.select("doc_id", "digest", "copies",
                                   F.when(F.col("found").isNull(), F.col("doc_id")).otherwise(F.col("found.keep_id")).alias("keep_id"),
                                   F.coalesce("found.size", F.lit(1).cast("long")).alias("size")), "dedup-groups")
    return _shape(_separate(rows, *_compare(rows, texts, digest)))


def _shape(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "keep_id", F.col("size").alias("group_size"),
                       same(F.col("doc_id"), F.col("keep_id")).alias("kept"),
                       F.col("digest").alias("text_sha256"), "copies")


def _compare(rows: DataFrame, texts: DataFrame, digest: Column) -> tuple[DataFrame, DataFrame]:
    """Compare the full bytes of every hit with the retained document's.

    Returns the hits whose bytes differ, and the text of all hits; other documents' text
    is kept out of the shuffle by a runtime filter on the ids. A group's retained text is
    repeated once for every ``SALT_ROWS`` of its rows, so that a hot group never meets in
    one task.
    """
    hits = rows.where("size > 1").select(F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest"), "keep_id", "size")
    with settings(rows.sparkSession, FILTER_SETTINGS):
        content = materialize(
            texts.join(hits, same(F.col("doc_id"), F.col("hit_id")))
            .withColumn("digest", digest).where(F.col("digest") == F.col("hit_digest"))
            .select("doc_id", "digest", "keep_id", "size", F.length(whole("text")).cast("long").alias("length"),
                    squeezed("text").alias("bytes")), "dedup-content")
    salts = F.ceil(F.col("size") / SALT_ROWS).cast("int")
    retained = (content.where(same(F.col("doc_id"), F.col("keep_id")))
                .select(F.col("digest").alias("kept_digest"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("kept_salt"),
                        F.col("bytes").alias("kept_bytes")))
    salted = content.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
    differ = (salted.join(retained, (F.col("digest") == F.col("kept_digest")) & (F.col("salt") == F.col("kept_salt")))
              .where(F.col("bytes") != F.col("kept_bytes")).select("doc_id", "digest"))
    return materialize(differ, "dedup-differ"), content


def _separate(rows: DataFrame, differ: DataFrame, content: DataFrame) -> DataFrame:
    """Regroup by their bytes the groups in which some text differs; usually there are none."""
    if differ.isEmpty():
        return rows
    mixed = differ.select("digest").distinct()
    best = F.min(F.struct((-F.col("length")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    parts = content.join(mixed, "digest", "left_semi")
    groups = parts.groupBy("digest", "bytes").agg(best.alias("best"), F.count(F.lit(1)).alias("size"))
    again = (parts.groupBy("doc_id", "digest", "bytes").agg(F.count(F.lit(1)).alias("copies"))
             .join(groups, ["digest", "bytes"])
             .select("doc_id", "digest", "copies", F.col("best.doc_id").alias("keep_id"), "size"))
    return rows.join(mixed, "digest", "left_anti").select(*again.columns).unionByName(again)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, one row each, with all columns of ``docs``."""
    found = materialize(exact_dedup(docs), "dedup-result")
    marked = boxed(docs, F.col("doc_id"), text_digest("text").alias("digest"))
    where = same(F.col("doc_id"), F.col("gone_id")) & (F.col("digest") == F.col("gone_digest"))

    def pick(condition: str) -> DataFrame:
        return found.where(condition).select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_digest"))

    kept = marked.join(pick("not kept or copies > 1"), where, "left_anti")
    if not found.where("kept and copies > 1").isEmpty():
        repeated = marked.join(pick("kept and copies > 1"), where, "left_semi")
        kept = kept.unionByName(repeated.dropDuplicates(["doc_id", "digest"]))
    return unboxed(kept, docs)
