"""Manifests and clips that Spark derives from the given tables, and the same in SQL.

``manifest_view`` turns every document into a manifest row. ``manifest_dirty`` also
plants faults by row number (blank texts, colliding ids, missing files, null
durations), so that guards and resume have something to find; no row is left out.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duolect.config import JobConfig
from duolect.functions import text as T
from duolect.functions.files import file_system, write_file
from duolect.operators.guards import (apply_guards, clip_exists, source_text_present,
                                      target_text_present)
from duolect.operators.resume import first_success_wins
from duolect.operators.shards import assign_shards, with_row_index
from duolect.plans.samples import sample_columns, select_rows

LANGUAGES = ("en", "fr", "de", "es")
DIRECTION = "enfr"
SHARDS = 4
DATA_ROOT = "/data"


def config(output_root: str = "/out", **changes) -> JobConfig:
    base = dict(data_root=DATA_ROOT, output_root=output_root, lang="en", direction=DIRECTION,
                languages=LANGUAGES, min_duration=3.0, max_duration=150.0, use_manifest_text=True,
                num_shards=SHARDS)
    return JobConfig(**{**base, **changes})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def manifest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    number = F.col("doc_id").cast("string")
    return docs.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        F.col("doc_id").alias("row_no"),
        F.concat(F.lit("src\\"), "source", F.lit("/"), number, F.lit(":"), "lang").alias("id"),
        "lang",
        F.col("source").alias("dataset"),
        F.when(F.col("doc_id") % 10 == 9, "test").otherwise("train").alias("split"),
        F.when(F.col("quality") == 1, "Gold").when(F.col("quality") == 0, "Silver").alias("tier"),
        F.concat(F.lit("keep\\"), "lang", F.lit("\\"), "source", F.lit("\\"), number,
                 F.lit(".wav")).alias("audio_path"),
        (F.col("n_chars").cast("double") / 15.0).alias("duration_s"),
        "text")


VIEW = r"""
manifest AS (
  SELECT d.doc_id AS row_no,
         'src\' || d.source || '/' || CAST(d.doc_id AS VARCHAR) || ':' || d.lang AS id,
         d.lang, d.source AS dataset,
         CASE WHEN d.doc_id % 10 = 9 THEN 'test' ELSE 'train' END AS split,
         CASE l.quality WHEN 1 THEN 'Gold' WHEN 0 THEN 'Silver' END AS tier,
         'keep\' || d.lang || '\' || d.source || '\' || CAST(d.doc_id AS VARCHAR) || '.wav' AS audio_path,
         CAST(d.n_chars AS DOUBLE) / 15.0 AS duration_s,
         d.text
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def every(count: int, remainder: int = 0) -> Column:
    return F.col("row_no") % count == remainder


def text_clip(text: Column, rate: int = 16000) -> Column:
    """A mono 8-bit WAV file whose samples are the UTF-8 bytes of a text."""
    payload = F.encode(text, "UTF-8")
    return wav_file(payload, rate, F.lit(1), 1)


def little_endian(value: Column, width: int) -> Column:
    digits = F.lpad(F.hex(value), 2 * width, "0")
    return F.unhex(F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(width))]))


def wav_file(payload: Column, rate: int | Column, channels: Column, width: int) -> Column:
    rate = F.lit(rate) if isinstance(rate, int) else rate
    size = F.octet_length(payload).cast("bigint")
    ascii_ = lambda tag: F.encode(F.lit(tag), "US-ASCII")
    return F.concat(
        ascii_("RIFF"), little_endian(size + 36, 4), ascii_("WAVEfmt "),
        little_endian(F.lit(16), 4), little_endian(F.lit(1), 2), little_endian(channels, 2),
        little_endian(rate, 4), little_endian(rate * channels * width, 4),
        little_endian(channels * width, 2), little_endian(F.lit(8 * width), 2),
        ascii_("data"), little_endian(size, 4), payload)


def manifest_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with planted faults; ``clip`` is null where the file is missing."""
    number = F.col("row_no").cast("string")
    before = (F.col("row_no") - 1).cast("string")
    blank = F.lit(" \t\n")
    return manifest_view(spark, sf_dir).withColumns({
        "present": ~every(83) & ~every(142),
        "done": every(7, 3),
        "spoken": F.col("text"),
        "text": F.when(every(97), F.lit(None)).when(every(89), blank).otherwise(F.col("text")),
        "id": F.when(every(71, 1), F.concat(F.lit("utt_"), before)).otherwise(
            F.concat(F.lit("utt/"), number)),
        "measured_s": F.when(every(53), F.col("duration_s") * 1.2).otherwise(F.col("duration_s")),
        "duration_s": F.when(~every(61), F.col("duration_s")),
    })


DIRTY = VIEW + r""",
dirty AS (
  SELECT row_no, lang, dataset, split, tier, audio_path,
         row_no % 83 <> 0 AND row_no % 142 <> 0 AS present,
         row_no % 7 = 3 AS done,
         text AS spoken,
         CASE WHEN row_no % 97 = 0 THEN NULL WHEN row_no % 89 = 0 THEN ' ' || chr(9) || chr(10)
              ELSE text END AS text,
         CASE WHEN row_no % 71 = 1 THEN 'utt_' || CAST(row_no - 1 AS VARCHAR)
              ELSE 'utt/' || CAST(row_no AS VARCHAR) END AS id,
         duration_s * (CASE WHEN row_no % 53 = 0 THEN 1.2 ELSE 1.0 END) AS measured_s,
         CASE WHEN row_no % 61 = 0 THEN NULL ELSE duration_s END AS duration_s
  FROM manifest)"""

_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(column: str) -> str:
    return f"regexp_replace({column}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def sql_words(column: str) -> str:
    return f"len(regexp_split_to_array({sql_strip(column)}, '{_SPACE}+'))"


def sql_sanitize(column: str) -> str:
    return rf"replace(replace(replace({column}, '/', '_'), '\', '_'), ':', '_')"


def sql_resolve(column: str) -> str:
    return (rf"CASE WHEN regexp_matches(replace({column}, '\', '/'), '^(/|[A-Za-z]:/|[A-Za-z][A-Za-z0-9+.-]*://)') "
            rf"THEN replace({column}, '\', '/') ELSE '{DATA_ROOT}/' || replace({column}, '\', '/') END")


def guarded_columns(df: DataFrame) -> DataFrame:
    """Sample columns and the text stand-in as plain columns: blank stays blank, some
    rows translate to nothing, the rest get the language tag."""
    translated = F.when(T.is_blank(F.col("text")) | every(79), "").otherwise(
        F.concat(F.lit("[fr] "), T.strip(F.col("text"))))
    return df.withColumnRenamed("id", "raw_id").withColumns({
        "sample_id": T.sanitize_id(F.col("raw_id")),
        "direction": F.lit(DIRECTION),
        "src_lang": F.lit("en"),
        "tgt_lang": F.lit("fr"),
        "resolved_path": T.resolve_path(F.col("audio_path"), DATA_ROOT),
        "src_text": F.col("text"),
        "tgt_text": translated,
    })


def dirty_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty rows of 3 to 150 s with positions, shards, guards and settled duplicates."""
    rows = manifest_dirty(spark, sf_dir).where(F.col("duration_s").between(3.0, 150.0))
    placed = assign_shards(with_row_index(rows), SHARDS)
    guarded = apply_guards(
        guarded_columns(placed),
        clip_exists(F.col("present"), F.col("resolved_path")),
        source_text_present(F.col("src_text"), F.col("sample_id")),
        target_text_present(F.col("tgt_text")))
    return first_success_wins(guarded)


OUTCOMES = DIRTY + rf""",
placed AS (
  SELECT *, row_number() OVER (ORDER BY row_no) - 1 AS idx,
         (row_number() OVER (ORDER BY row_no) - 1) % {SHARDS} AS shard
  FROM dirty WHERE duration_s BETWEEN 3.0 AND 150.0),
texts AS (
  SELECT *, id AS raw_id, {sql_sanitize('id')} AS sample_id, '{DIRECTION}' AS direction,
         {sql_resolve('audio_path')} AS resolved_path, text AS src_text,
         CASE WHEN text IS NULL OR {sql_strip('text')} = '' OR row_no % 79 = 0 THEN ''
              ELSE '[fr] ' || {sql_strip('text')} END AS tgt_text
  FROM placed),
guarded AS (
  SELECT *, CASE
    WHEN NOT present THEN 'FileNotFoundError(''Audio file not found: ' || resolved_path || ''')'
    WHEN src_text IS NULL OR {sql_strip('src_text')} = ''
      THEN 'ValueError("Empty manifest text for id=' || sample_id || ', column=''text''")'
    WHEN tgt_text = ''
      THEN 'ValueError(''[chatterbox-tts] Empty text provided for synthesis'')' END AS raw_error
  FROM texts),
firsts AS (
  SELECT *, min(CASE WHEN raw_error IS NULL THEN idx END) OVER (PARTITION BY sample_id) AS first_ok
  FROM guarded),
outcomes AS (
  SELECT *, CASE WHEN idx > first_ok THEN 'skipped' WHEN raw_error IS NULL THEN 'ok' ELSE 'error' END
            AS status,
         CASE WHEN idx > first_ok THEN NULL ELSE raw_error END AS error
  FROM firsts)"""


# Rates of the derived clips, picked by label.
CLIP_RATES = (8000, 16000, 22050, 44100, 48000)


def vector_clips(spark: SparkSession, sf_dir: str, mixed: bool = True) -> DataFrame:
    """Each embedding as a 16-bit WAV file. ``mixed`` varies the rate by label and makes
    every other clip stereo with the reversed vector on the right."""
    vectors = table(spark, sf_dir, "embeddings")
    pcm = F.transform("embedding", lambda x: F.least(F.greatest(
        F.rint(x.cast("double") * 32768.0), F.lit(-32768.0)), F.lit(32767.0)).cast("int"))
    stereo = (F.col("vec_id") % 2 == 1) & F.lit(mixed)
    rates = F.element_at(F.array(*map(F.lit, CLIP_RATES)), (F.col("label") % len(CLIP_RATES) + 1))
    with_pcm = vectors.select("vec_id", "label", pcm.alias("left")).withColumns({
        "channels": F.when(stereo, 2).otherwise(1),
        "rate": rates if mixed else F.lit(16000)})
    frames = F.when(F.col("channels") == 2, F.flatten(F.zip_with(
        "left", F.reverse("left"), lambda a, b: F.array(a, b)))).otherwise(F.col("left"))
    low = lambda v: F.lpad(F.hex(F.pmod(v, F.lit(256))), 2, "0")
    high = lambda v: F.lpad(F.hex(F.shiftright(F.pmod(v, F.lit(65536)), 8)), 2, "0")
    payload = F.unhex(F.array_join(F.transform(frames, lambda v: F.concat(low(v), high(v))), ""))
    return with_pcm.select("vec_id", wav_file(payload, F.col("rate"), F.col("channels"), 2).alias("content"))


VECTORS = rf"""
clips AS (
  SELECT vec_id, label, embedding AS x, 1 + vec_id % 2 AS channels,
         [{', '.join(map(str, CLIP_RATES))}][1 + label % {len(CLIP_RATES)}] AS rate,
         list_transform(embedding, lambda v: CAST(greatest(-32768, least(32767,
             round_even(CAST(v AS DOUBLE) * 32768, 0))) AS BIGINT)) AS pcm
  FROM embeddings),
mono AS (
  SELECT *, CASE WHEN channels = 2
                 THEN list_transform(range(1, len(pcm) + 1), lambda i: (pcm[i] + pcm[len(pcm) + 1 - i]) / 65536.0)
                 ELSE list_transform(pcm, lambda v: v / 32768.0) END AS wave
  FROM clips)"""


def sample_frame(spark: SparkSession, sf_dir: str, cfg: JobConfig) -> DataFrame:
    """Dirty rows as ``manifest_samples`` rows carrying their clip's bytes."""
    rows = (manifest_dirty(spark, sf_dir)
            .where(F.col("duration_s").between(cfg.min_duration, cfg.max_duration))
            .withColumn("clip", F.when(F.col("present"), text_clip(F.col("spoken"))))
            .drop("present", "done", "spoken", "measured_s"))
    return sample_columns(select_rows(with_row_index(rows), cfg), cfg)


def put_clips(clips: DataFrame) -> None:
    """Write each ``(path, content)`` row's file, in the task that has it."""
    def put(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, name = file_system(path)
                system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                write_file(system, name, content)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["path"])

    clips.mapInArrow(put, "path string").write.format("noop").mode("overwrite").save()


def corpus_files(spark: SparkSession, sf_dir: str, root: str) -> JobConfig:
    """Dirty rows as a job finds them: CSV manifests in row order and a WAV file for every
    clip that is not missing, under ``root``; and the settings of a job over them."""
    rows = manifest_dirty(spark, sf_dir).withColumn(
        "audio_path", F.concat(F.lit("clips\\"), F.col("row_no").cast("string"), F.lit(" %20.wav")))
    (rows.orderBy("row_no").select("text", "id", "lang", "dataset", "split", "tier", "audio_path", "duration_s").write
     .option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(f"{root}/manifest", header=True))
    clips = rows.where("present").select(
        T.resolve_path(F.col("audio_path"), root).alias("path"), text_clip(F.col("spoken")).alias("content"))

    put_clips(clips)
    return config(f"{root}/out", data_root=root, manifests={"en": f"{root}/manifest"})
