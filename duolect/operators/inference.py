"""Teacher models as distributed batch inference.

Models are given as zero-argument factories. A worker process builds one the first
time a stage needs it and keeps it for later tasks. Rows travel as Arrow batches;
columns a stage does not read are passed on untouched, and a row whose call raises
becomes an error row while its neighbours go on.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from duolect.config import AUDIO_ROWS, SOURCE_RATE, TARGET_RATE
from duolect.functions import text as T
from duolect.functions.audio import resample
from duolect.operators.guards import ERROR_COLUMNS, apply_guards, lang_pair_known

# Rows of text handled and handed back at a time.
TEXT_ROWS = 256
# What a model gets in one call: so many samples of audio, or characters, padding included.
AUDIO_BUDGET = AUDIO_ROWS * 30 * SOURCE_RATE
TEXT_BUDGET = 1 << 16

_LOADED: dict[tuple[str, str], Any] = {}


@dataclass(frozen=True)
class Teachers:
    """Factories of the models. ``asr`` is only needed when transcripts do not come from
    the manifest, ``translator`` and ``speaker`` not where their output is precomputed."""

    translator: Callable[[], Any] | None
    speaker: Callable[[], Any] | None
    synthesizer: Callable[[], Any] | None
    tokenizer: Callable[[], Any] | None
    asr: Callable[[], Any] | None = None
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def get(self, stage: str) -> Any:
        """The worker's own instance of a stage's model, built on first use."""
        key = (self.token, stage)
        if key not in _LOADED:
            factory = getattr(self, stage)
            if factory is None:
                raise ModelUnavailable(f"no factory configured for stage {stage!r}")
            for old in [k for k in _LOADED if k[0] != self.token]:
                del _LOADED[old]  # models of an earlier job would hold the device's memory
            try:
                _LOADED[key] = factory()
            except Exception as problem:
                raise ModelUnavailable(f"stage {stage!r} cannot be loaded: {problem!r}") from problem
        return _LOADED[key]


class ModelUnavailable(Exception):
    """A model that cannot be built: no fault of any row, so the task fails."""


class RowError(Exception):
    """An error found before this stage, reported as it was first described."""

    def __init__(self, kind: str, message: str, shown: str):
        super().__init__(kind, message, shown)


def _describe(problem: Exception) -> dict[str, str]:
    if isinstance(problem, RowError):
        kind, message, shown = problem.args
    else:
        one = len(problem.args) == 1 and isinstance(problem.args[0], str)
        kind, shown = type(problem).__name__, repr(problem)
        message = problem.args[0] if one else str(problem)
    return {"error_kind": kind, "error_msg": message, "error": shown}


def _no_memory(problem: Exception) -> bool:
    """Out of memory, of the host or as a device's library reports it."""
    return isinstance(problem, MemoryError) or type(problem).__name__ == "OutOfMemoryError"


def attempt(apply: Callable[[], Any]) -> Any:
    """The result of a call on one row, or its error: one bad row must not stop the others."""
    try:
        return apply()
    except Exception as problem:
        if isinstance(problem, ModelUnavailable) or _no_memory(problem):
            raise
        return problem


def by_cost(costs: Sequence[int], budget: int) -> Iterator[list[int]]:
    """Positions in batches of like cost, cheapest first. Items are padded to the dearest of their
    batch, and all of it stays within the budget, but for an item that exceeds it alone."""
    batch: list[int] = []
    for i in sorted(range(len(costs)), key=costs.__getitem__):
        if batch and costs[i] * (len(batch) + 1) > budget:
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def in_batches(items: Sequence[Any], one: Callable[[Any], Any], many: Callable[[list[Any]], Sequence[Any]] | None,
               cost: Callable[[Any], int], budget: int) -> list[Any]:
    """What a model makes of the items, in their order, an error in place of a failed one's.

    ``many`` gets batches of like cost within the budget. One that fails is halved, for
    want of memory too, down to single items, which go to ``one``; a single item that is
    too large for the memory, and a model that cannot be built, fail the task.
    """
    results: list[Any] = [None] * len(items)
    # a stack and no inner function that calls itself: such a one is a cycle, which would keep
    # the items and results of many calls until the garbage collector comes round
    for batch in by_cost([cost(item) for item in items], budget):
        waiting = [batch]
        while waiting:
            at = waiting.pop()
            if many is None or len(at) == 1:
                for i in at:
                    results[i] = attempt(lambda i=i: one(items[i]))
                continue
            try:
                for i, found in zip(at, many([items[i] for i in at]), strict=True):
                    results[i] = found
                continue
            except ModelUnavailable:
                raise
            except Exception:
                logging.warning("a call with %d rows failed; its halves are tried", len(at), exc_info=True)
            waiting += [at[len(at) // 2:], at[:len(at) // 2]]
    return results


def onward(values: Sequence[Any], stage: Callable[[list[Any]], Sequence[Any]]) -> list[Any]:
    """A stage over the values that are no errors; these stay in place."""
    good = [i for i, value in enumerate(values) if not isinstance(value, Exception)]
    results = list(values)
    for i, found in zip(good, stage([values[i] for i in good]), strict=True):
        results[i] = found
    return results


def infer_map(df: DataFrame, apply: Callable[[Any, dict], dict], inputs: Sequence[str],
              outputs: str, teachers: Teachers | None = None, drop: Sequence[str] = (),
              apply_many: Callable[[Any, list[dict]], Sequence[Any]] | None = None,
              profile: ResourceProfile | None = None, chunk_rows: int = AUDIO_ROWS,
              stages: Sequence[str] = ()) -> DataFrame:
    """Add ``outputs`` (a DDL string) by calling ``apply(teachers, row)`` on each row.

    ``row`` holds the ``inputs`` columns. ``apply_many`` may handle the rows of a chunk
    together and give an error in place of a row's result (see ``in_batches``). Rows
    already in error are passed on without a call. ``profile`` asks the cluster for
    the resources of this stage, such as one GPU per task.

    Only faults of a row make an error row. The models of ``stages`` are built before
    a task's first call, and a model that cannot be built, or a row too large for the
    memory, fails the task and with it the job.
    """
    errors = "error_kind string, error_msg string, error string"
    added = StructType.fromDDL(f"{outputs}, {errors}")
    kept = [c for c in df.columns if c not in {*drop, *added.names}]
    source = df if "error_kind" in df.columns else df.withColumn("error_kind", F.lit(None).cast("string"))
    carried = [c for c in ERROR_COLUMNS if c in source.columns]
    source = source.select(*dict.fromkeys([*kept, *inputs, *carried]))
    schema = StructType([source.schema[c] for c in kept] + added.fields)
    arrow = to_arrow_schema(added)

    def call(rows: list[dict]) -> list[dict]:
        found = (apply_many(teachers, rows) if apply_many and rows else
                 [attempt(lambda row=row: apply(teachers, row)) for row in rows])
        return [_describe(x) if isinstance(x, Exception) else x for x in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, chunk_rows):
                chunk = whole.slice(at, chunk_rows)
                rows = chunk.select(list(inputs)).to_pylist()
                before = chunk.select(carried).to_pylist()
                good = [i for i, seen in enumerate(before) if seen["error_kind"] is None]
                for stage in stages if good else ():
                    teachers.get(stage)
                for i, result in zip(good, call([rows[i] for i in good]), strict=True):
                    before[i] = result
                columns = [chunk.column(c) for c in kept]
                columns += [pa.array([r.get(f.name) for r in before], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, kept + arrow.names)

    return source.mapInArrow(run, schema, profile=profile)


def spread(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """Even tasks for an expensive stage, by keys that are unique per row. A count that
    is given, or the session's number of shuffle partitions, keeps the planner from
    merging many small text rows into a few long tasks. Jobs give one by their rows."""
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def require_wave(waveform: np.ndarray, rate: int, expected: int, stage: str) -> np.ndarray:
    """A 1-D float32 waveform at the expected rate, or an error."""
    waveform = np.asarray(waveform, np.float32)
    if waveform.ndim != 1:
        raise ValueError(f"{stage} expects 1D mono audio, got shape {waveform.shape}")
    if rate != expected:
        raise ValueError(f"{stage} expects sr={expected}, got {rate}")
    return waveform


def squeeze_leading(values: np.ndarray, ndim: int) -> np.ndarray:
    """Drop leading axes of size one until ``ndim`` are left."""
    values = np.asarray(values)
    while values.ndim > ndim and values.shape[0] == 1:
        values = values[0]
    return values


def transcribe(teachers: Teachers, waveform: np.ndarray, rate: int, lang: str) -> str:
    require_wave(waveform, rate, SOURCE_RATE, "asr")
    return teachers.get("asr").transcribe(waveform, rate, lang).strip()


def transcribe_many(teachers: Teachers, waveforms: Sequence[np.ndarray], rate: int, langs: Sequence[str],
                    budget: int = AUDIO_BUDGET) -> list[Any]:
    """Transcripts or errors, through the model's ``transcribe_batch(waveforms, sr, languages)`` if it has one."""
    batched = getattr(teachers.get("asr"), "transcribe_batch", None)

    def many(items: list[tuple]) -> list[str]:
        waves = [require_wave(wave, rate, SOURCE_RATE, "asr") for wave, _ in items]
        return [text.strip() for text in batched(waves, rate, [lang for _, lang in items])]

    return in_batches(list(zip(waveforms, langs, strict=True)), lambda x: transcribe(teachers, x[0], rate, x[1]),
                      batched and many, lambda x: len(x[0]), budget)


def _vector(values: np.ndarray) -> np.ndarray:
    vector = squeeze_leading(values, 1)
    if vector.ndim != 1:
        raise ValueError(f"speaker vector must be 1D, got shape {vector.shape}")
    return vector.astype(np.float32)


def embed_speaker(teachers: Teachers, waveform: np.ndarray, rate: int) -> np.ndarray:
    require_wave(waveform, rate, SOURCE_RATE, "speaker")
    return _vector(teachers.get("speaker").embed(waveform, rate))


def embed_many(teachers: Teachers, waveforms: Sequence[np.ndarray], rate: int, budget: int = AUDIO_BUDGET) -> list[Any]:
    """Vectors or errors, through the model's ``embed_batch(waveforms, sr)`` if it has one."""
    batched = getattr(teachers.get("speaker"), "embed_batch", None)

    def many(waves: list[np.ndarray]) -> list[np.ndarray]:
        return [_vector(v) for v in batched([require_wave(wave, rate, SOURCE_RATE, "speaker") for wave in waves], rate)]

    return in_batches(waveforms, lambda wave: embed_speaker(teachers, wave, rate), batched and many, len, budget)


def _speech(model: Any, waveform: np.ndarray) -> np.ndarray:
    speech = np.asarray(waveform, np.float32)
    if speech.ndim == 2:
        speech = speech.mean(axis=0)
    return require_wave(speech, getattr(model, "sample_rate", TARGET_RATE), TARGET_RATE, "synthesizer")


def _require_text(text: str | None) -> str:
    if not (text or "").strip():
        raise ValueError(T.EMPTY_TARGET)
    return text


def synthesize(teachers: Teachers, text: str, vector: np.ndarray, lang: str,
               prompt: np.ndarray, exaggeration: float) -> np.ndarray:
    """Speech of ``text`` in the voice of the source clip, mono at the target rate."""
    model = teachers.get("synthesizer") if _require_text(text) else None
    return _speech(model, model.synthesize(text, vector, lang, prompt, exaggeration))


def synthesize_many(teachers: Teachers, items: Sequence[tuple[str, np.ndarray, str, np.ndarray]], exaggeration: float,
                    budget: int = TEXT_BUDGET) -> list[Any]:
    """Speech or errors of (text, vector, language, prompt), through the model's
    ``synthesize_batch(texts, vectors, languages, prompts, exaggeration)`` if it has one."""
    model = teachers.get("synthesizer")
    batched = getattr(model, "synthesize_batch", None)

    def many(some: list[tuple]) -> list[np.ndarray]:
        texts, vectors, langs, prompts = (list(c) for c in zip(*some, strict=True))
        return [_speech(model, x) for x in batched([_require_text(t) for t in texts], vectors, langs, prompts, exaggeration)]

    return in_batches(items, lambda x: synthesize(teachers, *x, exaggeration), batched and many, lambda x: len(x[0] or ""), budget)


def _codec_input(model: Any, waveform: np.ndarray, rate: int) -> np.ndarray:
    waveform = require_wave(waveform, rate, rate, "tokenizer")
    if rate != model.sample_rate:
        waveform = resample(waveform, rate, model.sample_rate).astype(np.float32)
    channels = getattr(model, "channels", 1)
    if channels != 1:
        return np.repeat(waveform[None, None, :], channels, axis=1)
    alike = waveform[None, None, :]  # no copy; the speech is still to be stored, so a model may not write to it
    alike.flags.writeable = False
    return alike


def _codes(values: np.ndarray) -> np.ndarray:
    codes = np.asarray(values)
    if codes.ndim != 3:
        raise ValueError(f"tokenizer must return [batch, codebook, frame], got shape {codes.shape}")
    return squeeze_leading(codes, 2).astype(np.int64)


def tokenize(teachers: Teachers, waveform: np.ndarray, rate: int, bandwidth: float) -> np.ndarray:
    """Codebook indices ``[codebook, frame]`` of a waveform at the codec's own rate."""
    model = teachers.get("tokenizer")
    return _codes(model.encode(_codec_input(model, waveform, rate), bandwidth))


def tokenize_many(teachers: Teachers, waveforms: Sequence[np.ndarray], rate: int, bandwidth: float,
                  budget: int = AUDIO_BUDGET) -> list[Any]:
    """Codes or errors, through the model's ``encode_batch(waves[1, C, T] each, bandwidth)``
    if it has one; clips differ in length, so each comes and goes by itself."""
    model = teachers.get("tokenizer")
    batched = getattr(model, "encode_batch", None)

    def many(waves: list[np.ndarray]) -> list[np.ndarray]:
        return [_codes(x) for x in batched([_codec_input(model, wave, rate) for wave in waves], bandwidth)]

    return in_batches(waveforms, lambda wave: tokenize(teachers, wave, rate, bandwidth), batched and many, len, budget)


def translate_texts(df: DataFrame, teachers: Teachers, languages: Sequence[str],
                    text: str = "src_text", partitions: int | None = None,
                    profile: ResourceProfile | None = None, budget: int = TEXT_BUDGET,
                    memory: DataFrame | None = None) -> DataFrame:
    """Add ``tgt_text``: blank text gives ``""`` without a call, every distinct text
    of a language pair is translated once, and unknown pairs are error rows.
    ``memory`` holds earlier translations (``src_lang``, ``tgt_lang``, ``text_key``, ``tgt_text``,
    a row for a key): what it has is not translated again.

    Repeats are merged before the shuffle, so a text very many rows share reaches
    the model once. Translations are joined back by the text's SHA-256: the text itself
    only travels to the model. The equi-join is one the adaptive planner splits.
    """
    pair = ["src_lang", "tgt_lang", text]
    key = ["src_lang", "tgt_lang", "_text_key"]
    blank = T.is_blank(F.col(text))
    text_key = T.text_key(F.col(text))
    guarded = apply_guards(df, lang_pair_known(
        F.col("src_lang"), F.col("tgt_lang"), F.col(text), languages)).drop("status")
    distinct = guarded.where(F.col("error_kind").isNull() & ~blank).select(*pair).distinct()

    def one(models: Teachers, row: dict) -> dict:
        model = models.get("translator")
        return {"_tgt": model.translate(row[text], row["src_lang"], row["tgt_lang"]).strip()}

    def many(models: Teachers, rows: list[dict]) -> list[Any]:
        batched = getattr(models.get("translator"), "translate_batch", None)
        done: list[Any] = [None] * len(rows)
        for src, tgt in {(r["src_lang"], r["tgt_lang"]) for r in rows}:
            at = [i for i, r in enumerate(rows) if (r["src_lang"], r["tgt_lang"]) == (src, tgt)]
            together = batched and (lambda some, src=src, tgt=tgt: [
                {"_tgt": out.strip()} for out in batched([r[text] for r in some], src, tgt)])
            found = in_batches([rows[i] for i in at], lambda row: one(models, row), together, lambda row: len(row[text]), budget)
            for i, out in zip(at, found, strict=True):
                done[i] = out
        return done

    named = distinct.withColumn("_text_key", text_key)
    if memory is not None:
        known = memory.select("src_lang", "tgt_lang", F.col("text_key").alias("_text_key"), F.col("tgt_text").alias("_tgt"))
        named = named.join(known, key, "left_anti")
    translated = (infer_map(spread(named, partitions, *key), one, [*pair], "_tgt string", teachers, drop=[text],
                            apply_many=many, profile=profile, chunk_rows=TEXT_ROWS, stages=["translator"])
                  .withColumnsRenamed({c: f"_{c}" for c in ERROR_COLUMNS}))
    if memory is not None:
        translated = translated.unionByName(known, allowMissingColumns=True)
    earlier = F.col("error_kind").isNotNull()
    found = {c: F.when(earlier, F.col(c)).otherwise(F.col(f"_{c}")) for c in ERROR_COLUMNS}
    return (guarded.withColumn("_text_key", text_key).join(translated, key, "left")
            .withColumns({"tgt_text": F.when(blank, "").otherwise(F.col("_tgt")), **found})
            .select(*guarded.columns, "tgt_text"))


def isolate_rows(df: DataFrame, apply: Callable[[dict], Any], inputs: Sequence[str],
                 outputs: str) -> DataFrame:
    """Run a plain per-row function under the same isolation and set ``status``."""
    mapped = infer_map(df, lambda _, row: apply(row), inputs, outputs, chunk_rows=TEXT_ROWS)
    return mapped.withColumn("status", F.when(F.col("error_kind").isNull(), "ok").otherwise("error"))
