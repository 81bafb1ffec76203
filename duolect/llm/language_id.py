"""Language identification by rank-order profiles.

A language's profile is its most frequent n-grams in order, over all documents marked
with it. A document's own most frequent n-grams are compared with each profile by how
far out of place they are; the nearest profile wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from duolect.llm.common import bound_batches, boxed, let_go, slabs, unboxed, whole
from duolect.llm.labelled import held_out

# Held out: documents whose crc32 of the id leaves this remainder.
FOLDS, FOLD = 4, 2
# N-grams in a profile, of one to three letters.
PROFILE = 400
# N-grams that wait to be counted, 8 bytes each.
WAITING = 1 << 19
UNKNOWN = "und"
# What stands for everything between words; no letter has this code point.
GAP = 1

_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def ngrams(text: str) -> np.ndarray:
    """Codes of the n-grams of a text's lower-case words, repeats included.

    Words are runs of letters; two- and three-letter n-grams may take in the gap before
    or after a word. A code is the code points, 21 bits each.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letters = _is_letter()[points]
    points = np.where(letters, points, GAP)
    keep = letters | np.r_[True, letters[:-1]] if len(points) else letters
    run = np.concatenate([[GAP], points[keep], [GAP]]).astype(np.int64)
    if len(run) > 2 and run[1] == GAP:
        run = run[1:]
    if len(run) > 2 and run[-2] == GAP:
        run = run[:-1]
    two = run[:-1] << 21 | run[1:]
    three = two[:-1] << 21 | run[2:]
    return np.concatenate([run[run != GAP], two[run[:-1] + run[1:] != 2 * GAP], three[run[1:-1] != GAP]])


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and how often each occurs."""
    parts = [np.unique(ngrams(part), return_counts=True) for part in slabs(text)]
    return merged(parts) if len(parts) != 1 else parts[0]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order; of equally frequent ones the smaller code first."""
    if len(counts) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))[:size]]


def tallied(pairs: Iterable[tuple[str, str]], waiting: int = WAITING) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Distinct n-grams of all texts of each language and how often each occurs, from (language, text) pairs.

    N-grams are counted whenever ``waiting`` of them have come up, so that a batch of texts is never held as n-grams.
    """
    seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    grams: dict[str, list[np.ndarray]] = {}

    def count() -> None:
        for lang, parts in grams.items():
            new = np.unique(np.concatenate(parts), return_counts=True)
            seen[lang] = merged([seen[lang], new]) if lang in seen else new
        grams.clear()

    held = 0
    for lang, text in pairs:
        for part in slabs(text):
            grams.setdefault(lang, []).append(ngrams(part))
            held += len(grams[lang][-1])
            if held >= waiting:
                count()
                held = 0
    count()
    return seen


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles by language from all rows of ``docs`` with a language: n-gram counts of every text.

    Counts are summed in each task first; the driver gets ``size`` n-grams a language.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        pairs = (pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        seen = tallied(pairs)
        for lang, (codes, counts) in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                                             ["lang", "code", "n"])

    rows = docs.where("lang is not null").select("lang", whole("text").alias("text")).mapInArrow(run, "lang string, code long, n long")
    totals = rows.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = totals.withColumn("place", place).where(F.col("place") <= size).select("lang", "place", "code")
    found: dict[str, list] = {}
    for row in sorted(top.collect()):
        found.setdefault(row.lang, []).append(row.code)
    return {lang: np.array(codes, np.int64) for lang, codes in sorted(found.items())}


class Nearest:
    """The profiles side by side: the place of each n-gram in each of them."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE):
        self.names, self.size = list(profiles), size
        self.codes = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
        self.places = np.full((len(profiles), len(self.codes)), -1, np.int64)
        for row, codes in zip(self.places, profiles.values(), strict=True):
            row[np.searchsorted(self.codes, codes)] = np.arange(len(codes))

    def __call__(self, text: str) -> tuple[str, float]:
        """Language and score: one less the share of the greatest possible distance."""
        own = ranked(*counted(text), self.size)
        if not len(own) or not len(self.codes):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        places = np.where(self.codes[at] == own, self.places[:, at], -1)
        apart = np.where(places < 0, self.size, np.abs(places - np.arange(len(own)))).sum(axis=1)
        best = int(apart.argmin())
        return self.names[best], 1.0 - float(apart[best]) / (self.size * len(own))


def identify(rows: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """All columns of ``rows``, with ``lang_pred`` and ``score`` from its last one, the text.

    Only the text is looked at. The language is ``und`` with score 0 where the text is
    null or has no letter, or where there are no profiles; of languages equally near the
    first by name is taken. Rows that repeat come out as often as they come in.
    """
    bound_batches(rows.sparkSession)
    nearest = Nearest(profiles)
    schema = StructType([*rows.schema.fields[:-1], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = [nearest(text or "") for text in batch.columns[-1].to_pylist()]
            columns = [*batch.columns[:-1], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def _learnt(docs: DataFrame) -> dict[str, np.ndarray]:
    return learn(docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).where(~held_out(FOLDS, FOLD)))


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Profiles are learnt from the documents that are not held out and have a language.
    An empty table gives no rows.
    """
    return identify(docs.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), F.col("text").cast("string").alias("text")), _learnt(docs))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` for the documents in which a language was recognised.

    Where no document has a language to learn from, none can be told from another: then
    just the documents without a letter go, as they do otherwise.
    """
    profiles = _learnt(docs)
    if not profiles:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    found = identify(boxed(docs, F.col("text").cast("string").alias("text")), profiles)
    return unboxed(found.where(F.col("lang_pred") != UNKNOWN), docs)
