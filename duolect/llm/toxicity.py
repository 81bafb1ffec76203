"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Only documents are labelled. A sentence's probability is a logistic function of its
words, and a document's is the noisy-or of its sentences, one less the product of their
complements; weights are fitted to the documents' labels through it. Afterwards the
sentence scores say where the offence is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duolect.llm.common import bound_batches, whole
from duolect.llm.labelled import held_out, sample

# Held out: documents whose crc32 of the id leaves this remainder.
FOLDS, FOLD = 5, 0
# Most labelled documents learnt from.
SAMPLE_ROWS = 16_000
# Most features given a weight: those most clearly more frequent in toxic documents.
FEATURES = 4096
LEAST_Z = 4.0
LEAST_DOCUMENTS = 3
TOXIC = 0.5
KNOWN_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """Start and end (code points) of each sentence with a word, and its lower-case words."""
    for found in SENTENCE.finditer(text):
        words = set(WORD.findall(found.group().lower()))
        if words:
            yield found.start(), found.end(), words


def word_features(word: str) -> list[str]:
    """The word, its first four and five letters and its last four, where it is longer."""
    found = [word]
    if len(word) > 4:
        found += [f"^{word[:4]}", f"{word[-4:]}$"]
    if len(word) > 5:
        found.append(f"^{word[:5]}")
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    known: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        if word not in self.known:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return self.known[word]

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability and the sentences that are likelier toxic than not."""
        known, word, bias = self.known, self.word, self.bias
        doubt, spans = 0.0, []
        quiet = float(np.logaddexp(0.0, bias))
        for start, end, words in sentences(text):
            raw = 0.0
            for w in words:
                raw += known[w] if w in known else word(w)
            if raw == 0.0:
                doubt += quiet
                continue
            doubt += float(np.logaddexp(0.0, bias + raw))
            if bias + raw >= 0.0:
                spans.append((start, end, float(1 / (1 + np.exp(-min(bias + raw, 30.0))))))
        return float(-np.expm1(-doubt)), spans


def _features_seen(chosen: DataFrame) -> DataFrame:
    """feature, toxic, clean: in how many documents of either kind; summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(WORD.findall(text.lower()))
                counts[label > 0].update({f for w in words for f in word_features(w)})
        names = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(names), 50_000):
            some = names[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([counts[1][f] for f in some], pa.int64()),
                                              pa.array([counts[0][f] for f in some], pa.int64())], ["feature", "toxic", "clean"])

    counted = chosen.select("label", "text").mapInArrow(run, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _select(seen: DataFrame, toxic: int, clean: int) -> list[str]:
    """The features whose share in toxic documents is most significantly greater."""
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    spread = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean) + 1e-12)
    z = (F.col("toxic") / toxic - F.col("clean") / clean) / spread
    best = (seen.where(F.col("toxic") >= LEAST_DOCUMENTS).withColumn("z", F.round(z, 9)).where(F.col("z") > LEAST_Z)
            .orderBy(F.desc("z"), "feature").limit(FEATURES))
    return [row.feature for row in best.collect()]


def fit(labels: np.ndarray, bags: list[list[list[int]]], rest: np.ndarray, features: int,
        rounds: int = 400, rate: float = 0.05, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of the labels under noisy-or.

    ``bags`` has for each document the feature numbers of those sentences that have any,
    ``rest`` the number of its other sentences.
    """
    token = np.array([f for bag in bags for s in bag for f in s], np.int64)
    owner = np.repeat(np.arange(sum(map(len, bags))), [len(s) for bag in bags for s in bag]) if len(token) else np.zeros(0, np.int64)
    document = np.repeat(np.arange(len(bags)), [len(bag) for bag in bags])
    count = len(document)
    theta, mean, square = np.zeros(features + 1), np.zeros(features + 1), np.zeros(features + 1)
    theta[-1] = -6.0
    for step in range(1, rounds + 1):
        raw = np.clip(np.bincount(owner, theta[token], count) + theta[-1], -30, 30)
        doubt = np.bincount(document, np.logaddexp(0, raw), len(bags)) + rest * np.logaddexp(0, theta[-1])
        pull = labels * np.exp(-doubt) / np.clip(-np.expm1(-doubt), 1e-9, 1) - (1 - labels)
        each = pull[document] / (1 + np.exp(-raw))
        slope = np.bincount(token, each[owner], features) / len(bags) - ridge * theta[:-1]
        slope = np.append(slope, (each.sum() + (pull * rest).sum() / (1 + np.exp(-theta[-1]))) / len(bags))
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        theta = theta + rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit to at most ``rows`` labelled documents; None unless both labels occur.

    The driver gets the chosen features and, of the sampled documents, the numbers of
    the features in their sentences.
    """
    bound_batches(docs.sparkSession)
    chosen = sample(docs, labels, "toxic", FOLDS, FOLD, rows)
    sizes = {row.toxic: row["count"] for row in chosen.groupBy((F.col("label") > 0).alias("toxic")).count().collect()}
    if len(sizes) < 2:
        return None
    names = _select(_features_seen(chosen), sizes[True], sizes[False])
    numbers = {name: number for number, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags, rest = [], []
            for text in batch.column(1).to_pylist():
                found = [[numbers[f] for w in words for f in word_features(w) if f in numbers] for _, _, words in sentences(text)]
                bags.append([sorted(s) for s in found if s])
                rest.append(len(found) - len(bags[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.list_(pa.list_(pa.int32()))), pa.array(rest, pa.int64())],
                                             ["label", "bag", "rest"])

    bags = sorted(map(tuple, chosen.select("label", "text").mapInArrow(run, "label double, bag array<array<int>>, rest long").collect()))
    found = np.array([float(label > 0) for label, _, _ in bags])
    weights, bias = fit(found, [bag for _, bag, _ in bags], np.array([n for _, _, n in bags], float), len(names))
    return Model({name: float(w) for name, w in zip(names, weights, strict=True) if w}, bias)


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and sentences of every row of ``docs``.

    ``sentences`` has start, end (code points of the text) and score of those likelier
    toxic than not. Scores look at nothing but the text, the whole of it; a null or
    empty text, or one without words, has no sentence and scores 0. Without documents of
    both labels to learn from every score is 0. Rows that repeat come out as often as
    they come in.
    """
    model = learn(docs, labels, rows)
    kind = "sentences array<struct<start:int,end:int,score:double>>"
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(f"score double, {kind}").fields])
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(text) if model else (0.0, []) for text in batch.column(1).to_pylist()]
            named = [[{"start": a, "end": b, "score": p} for a, b, p in s] for _, s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p for p, _ in found], pa.float64()), pa.array(named, spans)],
                                             schema.names)

    scored = docs.select("doc_id", whole(F.col("text").cast("string")).alias("text")).mapInArrow(run, schema)
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score",
                         (F.col("score") >= TOXIC).cast("int").alias("predicted"), "sentences")
