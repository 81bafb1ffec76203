"""Model stages with stand-ins, audio work, the whole job and its exports.

The stand-ins are formulas, so the SQL can say what every stage must return.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from duolect.checks.fixtures import (DIRTY, VECTORS, VIEW, config, corpus_files, manifest_dirty, manifest_view,
                                     put_clips, sample_frame, sql_sanitize, sql_strip, text_clip, vector_clips)
from duolect.checks.registry import check
from duolect.config import SOURCE_RATE
from duolect.functions import text as T
from duolect.functions.audio import decode_wav, load_mono, mono
from duolect.operators import inference as I
from duolect.operators.resume import first_success_wins
from duolect.plans.build import run_job
from duolect.plans.memory import next_batches, translations
from duolect.plans.samples import add_source_text, infer_samples
from duolect.session import materialize, workspace
from duolect.sinks.export import export_samples as export_rows
from duolect.sinks.export import convert_clips, write_segments
from duolect.sinks.export import cut_clips as cut_files
from duolect.sinks.tables import read_errors
from duolect.sources.clips import clip_shapes, decode_clips, list_clips, scan_clips
from duolect.sources.done import read_dataset
from duolect.checks.standins import fail_on_multiple, standin_teachers


@check("asr_text", f"WITH {VIEW} SELECT row_no, md5({sql_strip('text')}) AS text_md5 FROM manifest")
def asr_text(spark, sf):
    clips = manifest_view(spark, sf).select(
        "row_no", F.lit("").alias("resolved_path"), text_clip(F.col("text")).alias("clip"),
        F.col("lang").alias("src_lang"))
    heard = add_source_text(clips, config(use_manifest_text=False), standin_teachers(with_asr=True))
    return heard.select("row_no", F.md5("src_text").alias("text_md5"))


def _sql_translated(text, tgt="fr"):
    strip = sql_strip(text)
    return (f"CASE WHEN {text} IS NULL OR {strip} = '' OR length({strip}) % 79 = 0 THEN '' "
            f"ELSE '[{tgt}] ' || {strip} END")


@check("translate_text", f"""WITH {DIRTY}, judged AS (
  SELECT *, text IS NOT NULL AND {sql_strip('text')} <> '' AND lang = 'es' AS bad FROM dirty)
SELECT row_no, CASE WHEN NOT bad THEN md5({_sql_translated('text')}) END AS tgt_md5,
       CASE WHEN bad THEN 'ValueError(''Unsupported language pair: es->fr'')' END AS error FROM judged""")
def translate_text(spark, sf):
    rows = manifest_dirty(spark, sf).select(
        "row_no", F.col("lang").alias("src_lang"), F.lit("fr").alias("tgt_lang"), F.col("text").alias("src_text"))
    done = I.translate_texts(rows, standin_teachers(), ("en", "fr", "de"))
    return done.select("row_no", F.md5("tgt_text").alias("tgt_md5"), "error")


_KNOWN = f"text IS NOT NULL AND {sql_strip('text')} <> '' AND lang <> 'es'"


@check("translation_memory", f"""WITH {DIRTY}, known AS (SELECT DISTINCT lang, text FROM dirty WHERE row_no % 3 = 0 AND {_KNOWN})
SELECT row_no, known.text IS NOT NULL AS recalled,
       CASE WHEN known.text IS NOT NULL THEN md5('kept ' || dirty.text)
            WHEN dirty.text IS NULL OR {sql_strip('dirty.text')} = '' OR dirty.lang <> 'es' THEN md5({_sql_translated('dirty.text')}) END AS tgt_md5
FROM dirty LEFT JOIN known USING (lang, text)""")
def translation_memory(spark, sf):
    """Rows after a run whose outcomes, a third of them, are remembered: these need no model."""
    rows = manifest_dirty(spark, sf).select(
        "row_no", F.col("lang").alias("src_lang"), F.lit("fr").alias("tgt_lang"), F.col("text").alias("src_text"))
    earlier = rows.where("row_no % 3 = 0 AND src_lang <> 'es'").withColumn("tgt_text", F.concat(F.lit("kept "), "src_text"))
    done = I.translate_texts(rows, standin_teachers(), ("en", "fr", "de"), memory=translations(earlier))
    marked = F.coalesce(F.col("tgt_text") == F.concat(F.lit("kept "), "src_text"), F.lit(False))
    return done.select("row_no", marked.alias("recalled"), F.md5("tgt_text").alias("tgt_md5"))


@check("translation_chain", f"""WITH {DIRTY}, seen AS (SELECT DISTINCT lang, text, row_no // 100 AS batch FROM dirty WHERE text IS NOT NULL),
following AS (SELECT *, lead(batch) OVER (PARTITION BY lang, text ORDER BY batch) AS next FROM seen)
SELECT lang AS src_lang, sha256(text) AS text_key, CAST(batch AS INTEGER) AS batch, CAST(next AS INTEGER) AS next
FROM following WHERE next IS NOT NULL""")
def translation_chain(spark, sf):
    """Where each text goes next, in a job of batches of 100 rows."""
    rows = manifest_dirty(spark, sf).where("text IS NOT NULL").select(
        F.col("lang").alias("src_lang"), F.lit("fr").alias("tgt_lang"), T.text_key(F.col("text")).alias("text_key"),
        F.floor(F.col("row_no") / 100).cast("int").alias("batch"))
    return next_batches(rows.distinct()).select("src_lang", "text_key", "batch", "next")


@check("row_isolation", f"""WITH {VIEW}
SELECT row_no, CASE WHEN row_no % 67 = 0 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN row_no % 67 = 0 THEN 'ValueError(''boom'')' END AS error FROM manifest""")
def row_isolation(spark, sf):
    rows = manifest_view(spark, sf).select("row_no")
    tried = I.isolate_rows(rows, lambda row: {"seen": fail_on_multiple(row["row_no"], 67)},
                           ["row_no"], "seen bigint")
    return tried.select("row_no", "status", "error")


@check("clip_decode", f"""WITH {VECTORS}
SELECT vec_id, channels, rate AS source_rate, rate AS sample_rate, len(wave) AS n_samples,
       CAST(list_sum(list_transform(range(1, len(wave) + 1), lambda i: i * CAST(wave[i] * 65536 AS BIGINT))) AS BIGINT)
         AS digest
FROM mono""")
def clip_decode(spark, sf):
    rows = decode_clips(vector_clips(spark, sf), target_rate=None)
    weighed = F.transform("samples", lambda v, i: (i + 1) * (v.cast("double") * 65536).cast("bigint"))
    return rows.select("vec_id", "channels", "source_rate", "sample_rate", "n_samples",
                       F.aggregate(weighed, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("digest"))


# the resampler's defining sum, written out term by term
_RESAMPLED = f"""{VECTORS},
ratio AS (SELECT vec_id, wave, rate, least(rate, 16000) * 0.99::DOUBLE / rate AS cutoff,
                 CAST(ceil(len(wave) * 16000 / rate::DOUBLE) AS BIGINT) AS n_out FROM mono),
outputs AS (SELECT vec_id, wave, rate, cutoff, n_out, unnest(range(n_out)) AS i FROM ratio),
taps AS (SELECT vec_id, i, rate, n_out, wave, cutoff, unnest(range(len(wave))) AS k FROM outputs),
terms AS (SELECT vec_id, i, n_out, wave[k + 1] AS x, cutoff,
                 (k - i * rate / 16000::DOUBLE) * cutoff AS z FROM taps),
sums AS (
  SELECT vec_id, i, n_out, sum(CASE WHEN abs(z) < 6 THEN x * cutoff * pow(cos(pi() * z / 12), 2) *
           CASE WHEN z = 0 THEN 1 ELSE sin(pi() * z) / (pi() * z) END ELSE 0 END) AS y
  FROM terms GROUP BY vec_id, i, n_out),
plain AS (SELECT vec_id, unnest(range(len(wave))) AS i, len(wave) AS n_out, unnest(wave) AS y
          FROM mono WHERE rate = 16000),
wave16 AS (SELECT * FROM plain UNION ALL
           SELECT vec_id, i, n_out, y FROM sums WHERE vec_id NOT IN (SELECT vec_id FROM mono WHERE rate = 16000))"""


@check("resample", f"""WITH {_RESAMPLED}
SELECT vec_id, n_out AS n_samples, round(sum((i + 1) * CAST(CAST(y AS FLOAT) AS DOUBLE)), 3) AS digest,
       round(sum(pow(CAST(CAST(y AS FLOAT) AS DOUBLE), 2)), 4) AS energy
FROM wave16 GROUP BY vec_id, n_out""")
def resample(spark, sf):
    rows = decode_clips(I.spread(vector_clips(spark, sf), None, "vec_id"), target_rate=SOURCE_RATE)
    total = lambda f: F.aggregate(F.transform("samples", f), F.lit(0.0), lambda a, v: a + v)
    return rows.select(
        "vec_id", "n_samples",
        F.round(total(lambda v, i: (i + 1) * v.cast("double")), 3).alias("digest"),
        F.round(total(lambda v, i: v.cast("double") * v.cast("double")), 4).alias("energy"))


def _embed_native(models, row):
    """Embed at the clip's own rate, so clips at another rate must be refused."""
    frames, rate = decode_wav(row["content"])
    return {"spk": I.embed_speaker(models, mono(frames), rate)}


def _embed(models, row):
    return {"spk": I.embed_speaker(models, load_mono(row["content"], SOURCE_RATE), SOURCE_RATE)}


@check("guard_shape_rate", f"""WITH {VECTORS}
SELECT vec_id, CASE WHEN rate = 16000 THEN 4 END AS dims,
       CASE WHEN rate <> 16000 THEN 'speaker expects sr=16000, got ' || CAST(rate AS VARCHAR) END AS error_msg
FROM clips""")
def guard_shape_rate(spark, sf):
    rows = I.infer_map(vector_clips(spark, sf), _embed_native, ["content"], "spk array<float>",
                       standin_teachers(), drop=["content"])
    return rows.select("vec_id", F.when(F.col("spk").isNotNull(), F.size("spk")).alias("dims"), "error_msg")


@check("speaker_embed", f"""WITH {VECTORS}, wave AS (
  SELECT vec_id, list_transform(pcm, lambda v: v / 32768.0::DOUBLE) AS w FROM clips)
SELECT vec_id, 4 AS dims, round(list_avg(w), 4) AS mean,
       round(sqrt(list_avg(list_transform(w, lambda v: v * v))), 4) AS rms,
       round(list_min(w), 4) AS low, round(list_max(w), 4) AS high FROM wave""")
def speaker_embed(spark, sf):
    rows = I.infer_map(vector_clips(spark, sf, mixed=False), _embed, ["content"], "spk array<float>",
                       standin_teachers(), drop=["content"])
    part = lambda i: F.round(F.element_at("spk", i).cast("double"), 4)
    return rows.select("vec_id", F.size("spk").alias("dims"), part(1).alias("mean"),
                       part(2).alias("rms"), part(3).alias("low"), part(4).alias("high"))


def _spoken(models, row):
    speech = I.synthesize(models, row["text"], None, "fr", [0] * row["prompt"], 0.9)
    return speech, len(speech)


def _synth_digest(models, row):
    speech, size = _spoken(models, row)
    pcm = (speech[[0, size // 2, -1]].astype("float64") * 32768).round().astype("int64")
    return {"n_target": size, "head": int(pcm[0]), "mid": int(pcm[1]), "tail": int(pcm[2])}


def _tokens(models, row):
    speech, _ = _spoken(models, row)
    return {"tokens": list(I.tokenize(models, speech, 24000, 6.0))}


_RAMP = "(({i}) * (1 + length(text) % 64) + octet_length(encode(text)) % 2048) % 2048 - 1024"


def _ramp(i):
    return _RAMP.replace("{i}", i)


def _texts(spark, sf):
    rows = manifest_view(spark, sf).select("row_no", "text", F.octet_length("text").alias("prompt"))
    return I.spread(rows, None, "row_no")


@check("synthesize", f"""WITH {VIEW}
SELECT row_no, 96 * length(text) AS n_target, {_ramp('0')} AS head, {_ramp('48 * length(text)')} AS mid,
       {_ramp('96 * length(text) - 1')} AS tail FROM manifest""")
def synthesize(spark, sf):
    rows = I.infer_map(_texts(spark, sf), _synth_digest, ["text", "prompt"],
                       "n_target bigint, head bigint, mid bigint, tail bigint", standin_teachers())
    return rows.select("row_no", "n_target", "head", "mid", "tail")


_CODES_SQL = """
framed AS (SELECT row_no, text, unnest(range(CAST(ceil(96 * length(text) / 320.0) AS BIGINT))) AS t FROM {rows}),
coded AS (SELECT row_no, t, unnest(range(8)) AS k, {ramp} AS pcm FROM framed),
codes AS (
  SELECT row_no, CAST(max(t) + 1 AS BIGINT) AS frames,
         CAST(sum(((pcm + 131 * k) % 1024 + 1024) % 1024) AS BIGINT) AS code_sum,
         CAST(sum(CASE WHEN k = 1 THEN (t + 1) * (((pcm + 131) % 1024 + 1024) % 1024) END) AS BIGINT) AS weighed
  FROM coded GROUP BY row_no)"""


def _token_columns():
    add = lambda a, v: a + v
    zero = F.lit(0).cast("bigint")
    return {
        "books": F.when(F.col("tokens").isNotNull(), F.size("tokens")),
        "frames": F.when(F.col("tokens").isNotNull(), F.size(F.element_at("tokens", 1)).cast("bigint")),
        "code_sum": F.aggregate(F.flatten("tokens"), zero, add),
        "weighed": F.aggregate(F.transform(F.element_at("tokens", 2), lambda v, i: v * (i + 1)), zero, add),
    }


@check("tokenize", f"""WITH {VIEW}, {_CODES_SQL.format(rows='manifest', ramp=_ramp('320 * t'))}
SELECT row_no, 8 AS books, frames, code_sum, weighed FROM codes""")
def tokenize(spark, sf):
    rows = I.infer_map(_texts(spark, sf), _tokens, ["text", "prompt"], "tokens array<array<bigint>>",
                       standin_teachers(), drop=["text"])
    return rows.withColumns(_token_columns()).select("row_no", "books", "frames", "code_sum", "weighed")


# what the job must make of the dirty manifest: errors in guard order, then first success
_BUILT = DIRTY + f""",
placed AS (SELECT *, row_number() OVER (ORDER BY row_no) - 1 AS idx, {sql_sanitize('id')} AS sample_id,
                  text AS src_text, {_sql_translated('text')} AS tgt_text
           FROM dirty WHERE duration_s BETWEEN 3.0 AND 150.0),
guarded AS (
  SELECT *, CASE
    WHEN NOT present THEN 'FileNotFoundError'
    WHEN src_text IS NULL OR {sql_strip('src_text')} = '' OR tgt_text = '' THEN 'ValueError' END AS kind
  FROM placed),
firsts AS (SELECT *, min(CASE WHEN kind IS NULL THEN idx END) OVER (PARTITION BY sample_id) AS first_ok FROM guarded),
settled AS (
  SELECT *, CASE WHEN idx > first_ok THEN 'skipped' WHEN kind IS NULL THEN 'ok' ELSE 'error' END AS status
  FROM firsts),
good AS (SELECT row_no, tgt_text AS text, spoken FROM settled WHERE status = 'ok'),
{_CODES_SQL.format(rows='good_text', ramp="((320 * t) * (1 + length(text) % 64) + prompt % 2048) % 2048 - 1024")
 .replace("SELECT row_no, text, unnest", "SELECT row_no, text, prompt, unnest")}"""
_BUILT = _BUILT.replace("framed AS", "good_text AS (SELECT row_no, text, octet_length(encode(spoken)) AS prompt "
                        "FROM good),\nframed AS", 1)

_SAMPLE_SQL = f"""WITH {_BUILT}
SELECT idx, id AS raw_id, sample_id, status, CASE status WHEN 'error' THEN kind END AS error_kind,
       CASE status WHEN 'ok' THEN md5(tgt_text) END AS tgt_md5,
       CASE status WHEN 'ok' THEN round(duration_s, 6) END AS src_duration_s,
       CASE status WHEN 'ok' THEN round(96 * length(tgt_text) / 24000.0, 6) END AS tgt_duration_s,
       CASE status WHEN 'ok' THEN length(src_text) END AS src_text_len,
       CASE status WHEN 'ok' THEN length(tgt_text) END AS tgt_text_len,
       CASE status WHEN 'ok' THEN 44 + 2 * octet_length(encode(spoken)) END AS src_wav_bytes,
       CASE status WHEN 'ok' THEN 44 + 192 * length(tgt_text) END AS tgt_wav_bytes,
       CASE status WHEN 'ok' THEN 8 END AS books, frames, code_sum, weighed
FROM settled LEFT JOIN codes USING (row_no)"""


def _sample_columns(df):
    good = F.col("status") == "ok"
    return df.withColumns(_token_columns()).select(
        "idx", "raw_id", "sample_id", "status", "error_kind",
        F.when(good, F.md5("tgt_text")).alias("tgt_md5"),
        F.when(good, F.round("src_duration_s", 6)).alias("src_duration_s"),
        F.when(good, F.round("tgt_duration_s", 6)).alias("tgt_duration_s"),
        *[F.when(good, F.col(f"meta.{c}")).alias(c) for c in ("src_text_len", "tgt_text_len")],
        *[F.when(good, F.octet_length(c)).alias(f"{c}_bytes") for c in ("src_wav", "tgt_wav")],
        *[F.when(good, F.col(c)).alias(c) for c in ("books", "frames", "code_sum", "weighed")])


@check("build_sample", _SAMPLE_SQL)
def build_sample(spark, sf):
    """The stages as one lazy plan; every row is inferred, then duplicates settled."""
    cfg = config()
    built = infer_samples(sample_frame(spark, sf, cfg), cfg, standin_teachers())
    return _sample_columns(first_success_wins(materialize(built, "built")))


@check("write_parallel", _SAMPLE_SQL)
def write_parallel(spark, sf):
    """The whole job with waves, stored outcomes, ledger and commit, read back."""
    cfg = config(workspace(spark, "job"))
    return _sample_columns(run_job(spark, cfg, standin_teachers(), sample_frame(spark, sf, cfg)).outcomes)


@check("rerun_ledger", f"""WITH {_BUILT}
SELECT id AS raw_id, kind AS error_kind, CASE WHEN first_ok IS NULL THEN 2 ELSE 1 END AS times
FROM settled WHERE status = 'error'""")
def rerun_ledger(spark, sf):
    """A second run retries the failures whose key has no success yet, and the ledger
    keeps both entries."""
    cfg = config(workspace(spark, "job"))
    for _ in range(2):
        run_job(spark, cfg, standin_teachers(), sample_frame(spark, sf, cfg))
    rows = read_errors(spark, cfg)
    return rows.groupBy("raw_id", "error_kind").agg(F.count(F.lit(1)).alias("times"))


_MANIFEST_JOB = _BUILT.replace("WHERE duration_s BETWEEN", "WHERE lang = 'en' AND duration_s BETWEEN")


@check("job_from_manifest", f"""WITH {_MANIFEST_JOB}
SELECT idx, id AS raw_id, idx % 4 AS shard, status, CASE status WHEN 'error' THEN kind END AS error_kind,
       CASE status WHEN 'ok' THEN md5(tgt_text) END AS tgt_md5,
       CASE status WHEN 'ok' THEN 44 + 2 * octet_length(encode(spoken)) END AS src_wav_bytes,
       CASE WHEN first_ok IS NULL THEN 'error' ELSE 'skipped' END AS again
FROM settled""")
def job_from_manifest(spark, sf):
    """The whole job from files: CSV manifests, clips opened by path, the language filter,
    several committed batches, and a second run that goes on from the first."""
    cfg = corpus_files(spark, sf, workspace(spark, "corpus"))
    sizes = run_job(spark, cfg, standin_teachers())
    later = run_job(spark, replace(cfg, rows_per_commit=-(-max(sizes.n_rows, 2) // 2)), standin_teachers())
    good = F.col("status") == "ok"
    return sizes.outcomes.select(
        "idx", "raw_id", "shard", "status", "error_kind", F.when(good, F.md5("tgt_text")).alias("tgt_md5"),
        F.when(good, F.octet_length("src_wav")).alias("src_wav_bytes")).join(
            later.outcomes.select("idx", F.col("status").alias("again")), "idx")


@check("export_samples", f"""WITH {_BUILT}
SELECT sample_id, 8 AS files FROM settled WHERE status = 'ok'""")
def export_samples(spark, sf):
    cfg = config(workspace(spark, "job"))
    run_job(spark, cfg, standin_teachers(), sample_frame(spark, sf, cfg))
    receipts = export_rows(read_dataset(spark, cfg), workspace(spark, "export"))
    return materialize(receipts, "receipts")


def _cut_clips(spark, sf):
    """A folder of cut clips, one for each vector."""
    root = workspace(spark, "cuts")
    clips = decode_clips(vector_clips(spark, sf, mixed=False), target_rate=None).select(
        F.concat(F.lit(root + "/"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("path"), "samples",
        "sample_rate", F.lit(0.001).alias("start_s"), F.lit(0.003).alias("end_s"))
    materialize(write_segments(clips), "receipts")
    return root


@check("clip_shapes", f"""WITH {VECTORS}
SELECT CAST(vec_id AS VARCHAR) || '_cut_0.001-0.003.wav' AS cut_name, CAST(44 + 64 AS BIGINT) AS length,
       16000 AS rate, 1 AS channels, CAST(32 AS BIGINT) AS frames FROM clips""")
def clip_shapes_from_headers(spark, sf):
    rows = clip_shapes(list_clips(spark, _cut_clips(spark, sf)))
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("cut_name"), "length", "rate", "channels", "frames")


@check("write_segment", f"""WITH {VECTORS}
SELECT CAST(vec_id AS VARCHAR) || '_cut_0.001-0.003.wav' AS cut_name, 32 AS n_samples,
       CAST(list_sum(list_transform(range(17, 49), lambda i: (i - 16) * pcm[i])) AS BIGINT) AS digest
FROM clips""")
def write_segment(spark, sf):
    root = _cut_clips(spark, sf)
    rows = decode_clips(scan_clips(spark, root), target_rate=None)
    weighed = F.transform("samples", lambda v, i: (i + 1) * (v.cast("double") * 32768).cast("bigint"))
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("cut_name"), "n_samples",
                       F.aggregate(weighed, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("digest"))


def _clip_files(spark, sf, root):
    """A file for each vector, of mixed rates and channels."""
    named = F.concat(F.lit(root + "/"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("path")
    clips = vector_clips(spark, sf).select("vec_id", named, "content")
    put_clips(clips.select("path", "content"))
    return clips.drop("content")


@check("cut_clips", f"""WITH {VECTORS},
bounded AS (SELECT *, CAST(floor(0.0005::DOUBLE * rate) AS BIGINT) AS first, CAST(floor(0.0025::DOUBLE * rate) AS BIGINT) AS last FROM mono)
SELECT CAST(vec_id AS VARCHAR) || '_cut_0.0005-0.0025.wav' AS cut_name, CASE WHEN last <= len(wave) THEN 1 ELSE 0 END AS files,
       CASE WHEN last > len(wave) THEN 'ValueError(''Invalid start or end times'')' END AS error,
       CASE WHEN last <= len(wave) THEN channels END AS channels, CASE WHEN last <= len(wave) THEN rate END AS sample_rate,
       CASE WHEN last <= len(wave) THEN last - first END AS n_samples,
       CASE WHEN last <= len(wave) THEN CAST(list_sum(list_transform(range(first + 1, last + 1),
         lambda i: (i - first) * CAST(wave[i] * 65536 AS BIGINT))) AS BIGINT) END AS digest
FROM bounded""")
def cut_clips(spark, sf):
    """Cuts made from files by range, read back; where the clip is too short there is an error."""
    root = workspace(spark, "clips")
    rows = _clip_files(spark, sf, root).select("path", F.lit(0.0005).alias("start_s"), F.lit(0.0025).alias("end_s"))
    receipts = materialize(cut_files(rows), "receipts")
    cuts = decode_clips(scan_clips(spark, root, "*_cut_*.wav"), target_rate=None)
    weighed = F.transform("samples", lambda v, i: (i + 1) * (v.cast("double") * 65536).cast("bigint"))
    found = cuts.select(F.col("path").alias("cut_path"), "channels", "sample_rate", "n_samples",
                        F.aggregate(weighed, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("digest"))
    return receipts.join(found, "cut_path", "left").select(
        F.element_at(F.split("cut_path", "/"), -1).alias("cut_name"), "files", "error", "channels", "sample_rate", "n_samples", "digest")


@check("convert_clips", f"""WITH {_RESAMPLED}
SELECT vec_id, n_out AS n_samples, 44 + 2 * n_out AS bytes, 16000 AS rate, 1 AS channels, true AS close
FROM wave16 GROUP BY vec_id, n_out""")
def convert_clips_files(spark, sf):
    """Clips rewritten as mono files of 16 kHz; read back, no sample is off by more than its rounding to 16 bits."""
    clips = _clip_files(spark, sf, workspace(spark, "clips"))
    root = workspace(spark, "converted")
    target = F.concat(F.lit(root + "/"), F.element_at(F.split("path", "/"), -1)).alias("out_path")
    receipts = materialize(convert_clips(clips.select("path", target)), "receipts")
    name = F.regexp_extract("path", r"([0-9]+)\.wav$", 1).cast("bigint").alias("vec_id")
    read = decode_clips(scan_clips(spark, root), target_rate=None).select(
        name, "length", F.col("sample_rate").alias("rate"), "channels", F.col("samples").alias("stored"), F.col("path").alias("out_path"))
    exact = decode_clips(vector_clips(spark, sf), target_rate=SOURCE_RATE).select("vec_id", "samples")
    apart = F.zip_with("stored", "samples", lambda a, b: F.abs(a.cast("double") - F.least(b.cast("double"), F.lit(32767 / 32768))))
    return (receipts.join(read, "out_path").join(exact, "vec_id")
            .select("vec_id", "n_samples", F.col("length").alias("bytes"), "rate", "channels",
                    ((F.size("stored") == F.size("samples")) & (F.array_max(apart) < 0.501 / 32768)).alias("close")))
