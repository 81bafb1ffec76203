"""Quality by compression: text is like what its dictionary compresses well.

Two zstandard dictionaries are trained, on blocks of good and of bad documents. A
document is compressed with both; the difference of the sizes, over their sum, says
which it is more like. A logistic curve fitted on other labelled documents turns that,
together with the two compression rates, into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from duolect.llm.common import bound_batches, whole
from duolect.llm.labelled import held_out, sample

# Held out: documents whose crc32 of the id leaves this remainder.
FOLDS, FOLD = 4, 2
# Most labelled documents learnt from: half train the dictionaries, half fit the curve.
SAMPLE_ROWS = 16_000
# Most blocks of a document, evenly spread over it, that the dictionaries are trained on.
TRAIN_BLOCKS = 4
BLOCK = 2048
DICTIONARY = 1 << 16
LEVEL = 3
GOOD = 0.7


def blocks(text: str) -> list[bytes]:
    """The UTF-8 bytes of a text in blocks; an empty text is one empty block."""
    data = text.encode("utf-8", "surrogatepass")
    return [data[at:at + BLOCK] for at in range(0, len(data), BLOCK)] or [b""]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


@dataclass(frozen=True)
class Model:
    bad: bytes
    good: bytes
    weights: tuple[float, ...] = ()

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data) if data else None,
                                         write_content_size=False) for data in (self.bad, self.good)]


def features(text: str, compressors: list[zstandard.ZstdCompressor]) -> list[float]:
    """One, the normalised difference of the compressed sizes, and the logarithms of both rates."""
    parts = blocks(text)
    bad, good = (sum(len(c.compress(part)) for part in parts) for c in compressors)
    size = sum(map(len, parts)) + 1
    return [1.0, (bad - good) / (bad + good), float(np.log(bad / size)), float(np.log(good / size))]


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 30, ridge: float = 1e-3) -> tuple[float, ...]:
    """Weights of a logistic curve, by Newton's method on standardised features."""
    shift, scale = rows.mean(axis=0), rows.std(axis=0)
    shift[0], scale[0] = 0.0, 1.0
    scale[scale == 0] = 1.0
    x = (rows - shift) / scale
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) / len(x) - ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(x.shape[1])
        weights = weights + np.linalg.solve(bend, slope)
    weights = weights / scale
    weights[0] -= (weights * shift)[1:].sum()
    return tuple(weights.tolist())


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Dictionaries and curve from at most ``rows`` labelled documents; None unless both labels occur in both halves."""
    bound_batches(docs.sparkSession)
    chosen = sample(docs, labels, "quality", FOLDS, FOLD, rows)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[float, bytes]] = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = blocks(text)
                found += [(label, parts[i * len(parts) // TRAIN_BLOCKS]) for i in range(TRAIN_BLOCKS)
                          if i == 0 or i * len(parts) // TRAIN_BLOCKS != (i - 1) * len(parts) // TRAIN_BLOCKS]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.float64()), pa.array([x for _, x in found], pa.binary())],
                                             ["label", "block"])

    def train(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": part["label"].iloc[:1], "data": [dictionary(sorted(part["block"]))]})

    trained = (chosen.where("half = 0").select("label", "text").mapInArrow(spread, "label double, block binary")
               .groupBy("label").applyInPandas(train, "label double, data binary"))
    data = {row.label: bytes(row.data) for row in trained.collect()}
    if set(data) < {0.0, 1.0}:
        return None
    model = Model(data[0.0], data[1.0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            found = [features(text, compressors) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["label", "found"])

    measured = chosen.where("half = 1").select("label", "text").mapInArrow(measure, "label double, found array<double>").collect()
    if len({row.label for row in measured}) < 2:
        return None
    order = sorted((row.found, row.label) for row in measured)
    return Model(model.bad, model.good, fit(np.array([x for x, _ in order]), np.array([y for _, y in order])))


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Scores look at nothing but the text, the whole of it; null counts as empty, and an
    empty text has a score like any other. Without documents of both labels to learn
    from every score is 0.5. Rows that repeat come out as often as they come in.
    """
    model = learn(docs, labels, rows)
    schema = StructType([docs.schema["doc_id"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors() if model else []
        weights = np.array(model.weights) if model else np.zeros(0)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            raw = np.array([features(text, compressors) for text in texts]).reshape(len(texts), -1) @ weights if model else np.zeros(len(texts))
            scores = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], schema.names)

    scored = docs.select("doc_id", whole(F.col("text").cast("string")).alias("text")).mapInArrow(run, schema)
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
