"""Scalar functions and guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from duolect.checks.fixtures import (DATA_ROOT, DIRTY, VIEW, config, every, manifest_dirty,
                                     manifest_view, sql_resolve, sql_sanitize, sql_strip, sql_words,
                                     table)
from duolect.checks.registry import check
from duolect.functions import arrays, meta
from duolect.functions import text as T
from duolect.operators import guards
from duolect.operators.filters import within_duration_tolerance
from duolect.plans.samples import add_source_text

_TURN = "lang || CASE WHEN lang = 'en' THEN 'fr' ELSE 'en' END"


def _direction():
    return F.concat("lang", F.when(F.col("lang") == "en", "fr").otherwise("en"))


def _sql_escape(message):
    return (f"replace(replace(replace(replace({message}, '\\', '\\\\'), chr(10), '\\n'), "
            f"chr(13), '\\r'), chr(9), '\\t')")


@check("sanitize_id", f"WITH {VIEW} SELECT row_no, {sql_sanitize('id')} AS sample_id FROM manifest")
def sanitize_id(spark, sf):
    return manifest_view(spark, sf).select("row_no", T.sanitize_id(F.col("id")).alias("sample_id"))


@check("direction_langs", f"""WITH {VIEW}
SELECT row_no, {_TURN} AS direction, lang AS src_lang,
       CASE WHEN lang = 'en' THEN 'fr' ELSE 'en' END AS tgt_lang FROM manifest""")
def direction_langs(spark, sf):
    return manifest_view(spark, sf).select("row_no", _direction().alias("direction")).withColumns({
        "src_lang": T.source_lang(F.col("direction")), "tgt_lang": T.target_lang(F.col("direction"))})


@check("lang_code", f"""WITH {VIEW}
SELECT row_no, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE upper(lang) END AS synth_code,
       upper(lang) AS plain_code FROM manifest""")
def lang_code(spark, sf):
    return manifest_view(spark, sf).select(
        "row_no", T.lang_code(F.col("lang"), {"en": "english", "fr": "french"}).alias("synth_code"),
        T.lang_code(F.col("lang")).alias("plain_code"))


@check("output_key", f"""WITH {VIEW}
SELECT row_no, 'data/parallel/' || {_TURN} || '/' || {sql_sanitize('id')} AS out_dir FROM manifest""")
def output_key(spark, sf):
    return manifest_view(spark, sf).select(
        "row_no", T.output_key(_direction(), T.sanitize_id(F.col("id"))).alias("out_dir"))


_ANY_PATH = r"CASE lang WHEN 'fr' THEN '\srv\' || audio_path WHEN 'de' THEN 'D:\' || audio_path ELSE audio_path END"


@check("resolve_path", f"""WITH {VIEW}, paths AS (SELECT row_no, {_ANY_PATH} AS p FROM manifest)
SELECT row_no, {sql_resolve('p')} AS resolved_path FROM paths""")
def resolve_path(spark, sf):
    given = (F.when(F.col("lang") == "fr", F.concat(F.lit("\\srv\\"), "audio_path"))
             .when(F.col("lang") == "de", F.concat(F.lit("D:\\"), "audio_path")).otherwise(F.col("audio_path")))
    return manifest_view(spark, sf).select("row_no", T.resolve_path(given, DATA_ROOT).alias("resolved_path"))


@check("source_text", f"WITH {VIEW} SELECT row_no, audio_path AS src_text FROM manifest")
def source_text(spark, sf):
    rows = add_source_text(manifest_view(spark, sf), config(text_column="audio_path"), None)
    return rows.select("row_no", "src_text")


_PADDED = "chr(160) || chr(9) || chr(28) || text || chr(8195) || chr(10) || chr(31) || chr(133)"


@check("strip_text", f"""WITH {VIEW}, padded AS (SELECT row_no, {_PADDED} AS t FROM manifest)
SELECT row_no, md5({sql_strip('t')}) AS stripped_md5, length({sql_strip('t')}) AS stripped_len FROM padded""")
def strip_text(spark, sf):
    padded = F.concat(F.lit("\u00a0\t\x1c"), "text", F.lit("\u2003\n\x1f\x85"))
    return manifest_view(spark, sf).select("row_no", T.strip(padded).alias("t")).select(
        "row_no", F.md5("t").alias("stripped_md5"), F.length("t").alias("stripped_len"))


@check("text_lengths", f"""WITH {VIEW}
SELECT row_no, length(text) AS src_text_len, length('[en] ' || text) AS tgt_text_len FROM manifest""")
def text_lengths(spark, sf):
    return manifest_view(spark, sf).select(
        "row_no", F.length("text").alias("src_text_len"),
        F.length(F.concat(F.lit("[en] "), "text")).alias("tgt_text_len"))


@check("durations", f"""WITH {DIRTY}
SELECT row_no, round(coalesce(duration_s, strlen(spoken) / 16000.0), 9) AS src_duration_s,
       round(96.0 * length(spoken) / 24000.0, 6) AS tgt_duration_s FROM dirty""")
def durations(spark, sf):
    return manifest_dirty(spark, sf).select(
        "row_no",
        F.round(meta.source_duration(F.col("duration_s"), F.octet_length("spoken"), F.lit(16000)), 9)
        .alias("src_duration_s"),
        F.round(meta.target_duration(96 * F.length("spoken")), 6).alias("tgt_duration_s"))


@check("text_preview", f"WITH {VIEW} SELECT row_no, left(text, 80) AS preview FROM manifest")
def text_preview(spark, sf):
    return manifest_view(spark, sf).select("row_no", T.preview(F.col("text")).alias("preview"))


@check("text_line", f"WITH {VIEW} SELECT row_no, md5(text || chr(10)) AS line_md5 FROM manifest")
def text_line(spark, sf):
    return manifest_view(spark, sf).select("row_no", F.md5(T.text_line(F.col("text"))).alias("line_md5"))


def _meta_rows(spark, sf):
    return manifest_view(spark, sf).withColumns({
        "sample_id": T.sanitize_id(F.col("id")), "src_lang": F.col("lang"), "tgt_lang": F.lit("it"),
        "dataset": F.when(~every(11), F.concat(F.lit("дзен-"), "dataset")),
        "src_duration_s": F.col("duration_s"), "tgt_duration_s": meta.target_duration(96 * F.length("text")),
        "src_text": F.col("text"), "tgt_text": F.concat(F.lit("[it] "), "text")})


def _parsed(rows, extra=()):
    names = [*meta.META_FIELDS, *extra]
    parsed = rows.select("row_no", "json", F.json_tuple("json", *names).alias(*names))
    typed = {"src_duration_s": "double", "tgt_duration_s": "double", "src_text_len": "bigint",
             "tgt_text_len": "bigint"}
    columns = [F.round(F.col(c).cast(typed[c]), 6).alias(c) if typed.get(c) == "double"
               else F.col(c).cast(typed.get(c, "string")).alias(c) for c in names]
    return parsed.select("row_no", F.size(F.json_object_keys("json")).alias("n_fields"), *columns)


_META_SQL = f"""row_no, %d AS n_fields, {sql_sanitize('id')} AS id, lang AS src_lang, 'it' AS tgt_lang,
       CASE WHEN row_no %% 11 <> 0 THEN 'дзен-' || dataset END AS dataset, split,
       round(duration_s, 6) AS src_duration_s, round(96.0 * length(text) / 24000.0, 6) AS tgt_duration_s,
       length(text) AS src_text_len, length('[it] ' || text) AS tgt_text_len, 'ok' AS status"""


@check("meta_json", f"WITH {VIEW} SELECT {_META_SQL % 10} FROM manifest")
def meta_json(spark, sf):
    rows = _meta_rows(spark, sf)
    return _parsed(rows.select("row_no", meta.meta_json(meta.meta_struct()).alias("json")))


@check("meta_passthrough", f"""WITH {VIEW}
SELECT {_META_SQL % 12}, tier, audio_path FROM manifest""")
def meta_passthrough(spark, sf):
    rows, extra = _meta_rows(spark, sf), ("tier", "audio_path")
    return _parsed(rows.select("row_no", meta.meta_json(meta.meta_struct(extra)).alias("json")), extra)


@check("guard_source_text", f"""WITH {DIRTY}
SELECT row_no,
       CASE WHEN text IS NULL OR {sql_strip('text')} = '' THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN text IS NULL OR {sql_strip('text')} = ''
            THEN 'Empty manifest text for id=' || {sql_sanitize('id')} || ', column=''text''' END AS error_msg
FROM dirty""")
def guard_source_text(spark, sf):
    guard = guards.source_text_present(F.col("text"), T.sanitize_id(F.col("id")))
    return guards.apply_guards(manifest_dirty(spark, sf), guard).select("row_no", "status", "error_msg")


@check("guard_file_exists", f"""WITH {DIRTY}
SELECT row_no, CASE WHEN present THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN NOT present THEN 'FileNotFoundError' END AS error_kind,
       CASE WHEN NOT present THEN 'Audio file not found: ' || {sql_resolve('audio_path')} END AS error_msg
FROM dirty""")
def guard_file_exists(spark, sf):
    guard = guards.clip_exists(F.col("present"), T.resolve_path(F.col("audio_path"), DATA_ROOT))
    return guards.apply_guards(manifest_dirty(spark, sf), guard).select(
        "row_no", "status", "error_kind", "error_msg")


@check("guard_target_text", f"""WITH {DIRTY}
SELECT row_no, CASE WHEN text IS NULL OR {sql_strip('text')} = '' OR row_no % 79 = 0 THEN 'error'
       ELSE 'ok' END AS status FROM dirty""")
def guard_target_text(spark, sf):
    translated = F.when(~every(79), F.concat(F.lit("[fr] "), "text"))
    target = F.when(T.is_blank(F.col("text")), "").otherwise(translated)
    return guards.apply_guards(manifest_dirty(spark, sf), guards.target_text_present(target)).select(
        "row_no", "status")


@check("guard_lang_pair", f"""WITH {DIRTY}
SELECT row_no, CASE WHEN bad THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN bad THEN 'ValueError(''Unsupported language pair: ' || lang || '->fr'')' END AS error
FROM (SELECT *, text IS NOT NULL AND {sql_strip('text')} <> '' AND lang NOT IN ('en', 'fr') AS bad FROM dirty)""")
def guard_lang_pair(spark, sf):
    guard = guards.lang_pair_known(F.col("lang"), F.lit("fr"), F.col("text"), ("en", "fr"))
    return guards.apply_guards(manifest_dirty(spark, sf), guard).select("row_no", "status", "error")


@check("filter_duration_mismatch", f"""WITH {DIRTY}
SELECT row_no, round(measured_s, 6) AS measured_s FROM dirty
WHERE abs(measured_s - duration_s) <= 0.1 * duration_s""")
def filter_duration_mismatch(spark, sf):
    return within_duration_tolerance(manifest_dirty(spark, sf)).select(
        "row_no", F.round("measured_s", 6).alias("measured_s"))


@check("guard_duration_mismatch", f"""WITH {DIRTY}
SELECT row_no, CASE WHEN abs(measured_s - duration_s) > 0.1 * duration_s THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN abs(measured_s - duration_s) > 0.1 * duration_s
            THEN printf('Duration mismatch: measured %.3fs, manifest %.3fs', measured_s, duration_s) END AS error_msg
FROM dirty""")
def guard_duration_mismatch(spark, sf):
    guard = guards.duration_matches(F.col("measured_s"), F.col("duration_s"))
    return guards.apply_guards(manifest_dirty(spark, sf), guard).select("row_no", "status", "error_msg")


@check("quality_flags", f"""WITH {DIRTY}
SELECT row_no,
       array_to_string(list_filter([CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty_text' END,
                        CASE WHEN length(spoken) // 100 < 5 THEN 'short_tokens' END],
                        lambda f: f IS NOT NULL), ',') AS flags
FROM dirty""")
def quality_flags(spark, sf):
    size = F.floor(F.length("spoken") / 100)
    frames = F.when(size > 0, F.sequence(F.lit(1).cast("bigint"), size)).otherwise(
        F.array().cast("array<bigint>"))
    flags = meta.quality_flags(F.col("text"), F.col("spoken"), F.array(frames, frames), 5)
    return manifest_dirty(spark, sf).select("row_no", F.array_join(flags, ",").alias("flags"))


@check("error_repr", f"""WITH {VIEW}
SELECT row_no, md5('ValueError(' || CASE
         WHEN contains(text, '''') AND NOT contains(text, '"') THEN '"' || {_sql_escape('text')} || '"'
         ELSE '''' || replace({_sql_escape('text')}, '''', '\\''') || '''' END || ')') AS error_md5
FROM manifest""")
def error_repr(spark, sf):
    return manifest_view(spark, sf).select(
        "row_no", F.md5(T.error_repr(F.lit("ValueError"), F.col("text"))).alias("error_md5"))


@check("blank_passthrough", f"""WITH {DIRTY}
SELECT row_no, text IS NULL OR {sql_strip('text')} = '' AS passed_through FROM dirty""")
def blank_passthrough(spark, sf):
    return manifest_dirty(spark, sf).select("row_no", T.is_blank(F.col("text")).alias("passed_through"))


_HEARD = """CASE lang WHEN 'fr' THEN 'uh ' || text WHEN 'de' THEN text || ' so so so'
            WHEN 'es' THEN ' ' || text || chr(10) ELSE text END"""


@check("text_compare", f"""WITH {VIEW}
SELECT row_no, lang IN ('en', 'es') AS exact_match, {sql_words('text')} AS ref_words,
       CASE lang WHEN 'fr' THEN 1 WHEN 'de' THEN 3 ELSE 0 END AS word_edits,
       round(CASE lang WHEN 'fr' THEN 1 WHEN 'de' THEN 3 ELSE 0 END / {sql_words('text')}, 6)
         AS word_error_rate
FROM manifest""")
def text_compare(spark, sf):
    heard = (F.when(F.col("lang") == "fr", F.concat(F.lit("uh "), "text"))
             .when(F.col("lang") == "de", F.concat("text", F.lit(" so so so")))
             .when(F.col("lang") == "es", F.concat(F.lit(" "), "text", F.lit("\n")))
             .otherwise(F.col("text")))
    rows = T.compare_transcripts(manifest_view(spark, sf).withColumn("src_text", heard))
    return rows.select("row_no", "exact_match", "ref_words", "word_edits",
                       F.round("word_error_rate", 6).alias("word_error_rate"))


@check("cast_arrays", """SELECT vec_id,
       round(list_sum(list_transform(embedding, lambda v:
         CAST(CAST(CAST(v AS DOUBLE) * 3 AS FLOAT) AS DOUBLE))), 4) AS float_sum,
       CAST(2 * list_sum(list_transform(embedding, lambda v:
         CAST(trunc(CAST(v AS DOUBLE) * 1000) AS BIGINT))) AS BIGINT) AS token_sum, 2 AS n_books, len(embedding) AS n_frames FROM embeddings""")
def cast_arrays(spark, sf):
    tripled = F.transform("embedding", lambda v: v.cast("double") * 3)
    codes = F.transform("embedding", lambda v: v.cast("double") * 1000)
    rows = table(spark, sf, "embeddings").select(
        "vec_id", arrays.as_float_vector(tripled).alias("v"),
        arrays.as_token_matrix(F.array(codes, codes)).alias("t"))
    add = lambda a, x: a + x.cast("double")
    return rows.select(
        "vec_id", F.round(F.aggregate("v", F.lit(0.0), add), 4).alias("float_sum"),
        F.aggregate(F.flatten("t"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("token_sum"),
        F.size("t").alias("n_books"), F.size(F.element_at("t", 1)).alias("n_frames"))


_MIX = """list_sum(list_transform(range(1, len(embedding) + 1),
          lambda i: i * (CAST(embedding[i] AS DOUBLE) + CAST(embedding[len(embedding) + 1 - i] AS DOUBLE)) / 2))"""


@check("mixdown", f"""SELECT vec_id, len(embedding) AS n_samples, round({_MIX}, 4) AS frames_sum,
       round({_MIX}, 4) AS channels_sum FROM embeddings""")
def mixdown(spark, sf):
    left, right = F.col("embedding"), F.reverse("embedding")
    frames = arrays.mixdown_frames(F.zip_with(left, right, lambda a, b: F.array(a, b)))
    channels = arrays.mixdown_channels(F.array(left, right))
    weigh = lambda values: F.round(F.aggregate(
        F.transform(values, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v), 4)
    return table(spark, sf, "embeddings").select(
        "vec_id", F.size("embedding").alias("n_samples"), weigh(frames).alias("frames_sum"),
        weigh(channels).alias("channels_sum"))


@check("squeeze_batch", """SELECT vec_id, len(embedding) AS n_values, round(CAST(embedding[1] AS DOUBLE), 5)
       AS first_value, 2 AS n_books, true AS refused FROM embeddings""")
def squeeze_batch(spark, sf):
    one, two = F.array("embedding"), F.array(F.array("embedding", "embedding"))
    vector = arrays.squeeze_batch(arrays.squeeze_batch(F.array(one)))
    return table(spark, sf, "embeddings").select(
        "vec_id", F.size(vector).alias("n_values"),
        F.round(F.element_at(vector, 1).cast("double"), 5).alias("first_value"),
        F.size(arrays.squeeze_batch(two)).alias("n_books"),
        arrays.squeeze_batch(F.array("embedding", "embedding")).isNull().alias("refused"))


_CUTS = """cuts AS (SELECT vec_id, embedding, (vec_id % 40) / 1000.0::DOUBLE AS start_s,
  (vec_id % 40) / 1000.0::DOUBLE + (vec_id % 9 - 1) / 250.0::DOUBLE AS end_s FROM embeddings),
sized AS (SELECT *, CAST(trunc(start_s * 1000) AS BIGINT) AS s, CAST(trunc(end_s * 1000) AS BIGINT) AS e,
  len(embedding) AS n FROM cuts),
judged AS (SELECT *, s >= 0 AND e <= n AND s < e AS valid FROM sized)"""


def _cuts(spark, sf):
    start = F.col("vec_id") % 40 / 1000.0
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").alias("samples"), F.lit(1000).alias("sample_rate"),
        start.alias("start_s"), (start + (F.col("vec_id") % 9 - 1) / 250.0).alias("end_s"))


@check("cut_segment", f"""WITH {_CUTS}
SELECT vec_id, CASE WHEN valid THEN e - s END AS n_samples,
       CASE WHEN valid THEN round(CAST(embedding[s + 1] AS DOUBLE), 5) END AS first_sample,
       CASE WHEN valid THEN round(CAST(embedding[e] AS DOUBLE), 5) END AS last_sample,
       'keep/' || CAST(vec_id AS VARCHAR) || '_cut_' || CAST(start_s AS VARCHAR) || '-' ||
         CAST(round(end_s, 3) AS VARCHAR) || '.wav' AS cut_path
FROM judged""")
def cut_segment(spark, sf):
    path = F.concat(F.lit("keep/"), F.col("vec_id").cast("string"), F.lit(".wav"))
    rows = _cuts(spark, sf).withColumn("cut", arrays.cut_samples(
        F.col("samples"), F.col("start_s"), F.col("end_s"), F.col("sample_rate")))
    edge = lambda i: F.round(F.element_at("cut", i).cast("double"), 5)
    return rows.select(
        "vec_id", F.size("cut").alias("n_samples"), edge(1).alias("first_sample"),
        edge(-1).alias("last_sample"),
        arrays.cut_name(path, F.col("start_s"), F.round("end_s", 3)).alias("cut_path"))


@check("guard_cut_bounds", f"""WITH {_CUTS}
SELECT vec_id, CASE WHEN valid THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN NOT valid THEN 'ValueError(''Invalid start or end times'')' END AS error FROM judged""")
def guard_cut_bounds(spark, sf):
    guard = guards.cut_bounds(F.col("start_s"), F.col("end_s"), F.col("sample_rate"), F.size("samples"))
    return guards.apply_guards(_cuts(spark, sf), guard).select("vec_id", "status", "error")
