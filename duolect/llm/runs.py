"""Periodic runs of words, from longest common extensions over a difference cover.

A run with period q repeats over at least ``TIMES`` periods, so from some multiple of 2q
in its first two periods on, a whole period of words equals the one after it. All such
pairs of places (a grid that thins out with q, so their number is harmonic: n log n) are
looked through; those that pass a few word comparisons are extended both ways. An extension
compares a few words; where all are equal it goes on from the next two places in the
difference cover and reads the rest from the common prefixes of the sampled suffixes, the
only ones sorted, by a range minimum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolect.llm.common import bound_batches, let_go, whole

# A perfect difference cover; every difference modulo 13 is one of two of these.
MODULUS, COVER = 13, (0, 1, 3, 9)
# What counts as a run: words in all, and times its period.
WORDS, TIMES = 6, 4
# Texts of so many words share one table of their grid; longer ones make theirs piece by piece.
SHARED = 1 << 14
# Pairs of a long text's grid that are looked at in one go.
CHUNK = 1 << 18

RUNS = "array<struct<start:long,length:long,period:long>>"
_GRID: list[np.ndarray] = []


class Extensions:
    """Longest common extensions to the right of places in a sequence of numbers from 1 up."""

    def __init__(self, words: np.ndarray):
        self.size = len(words)
        self.words = np.concatenate([words, np.zeros(2 * MODULUS, words.dtype)])
        # Where two places next reach the cover together: anchor[difference] is the first one's remainder there.
        anchor = np.empty(MODULUS, np.int64)
        for a in COVER:
            for b in COVER:
                anchor[(b - a) % MODULUS] = a
        self.anchor, self.rank, self.minima = anchor, None, []

    def _sort(self) -> None:
        """Rank the sampled suffixes by doubling, find common prefixes of neighbours, prepare range minima."""
        blocks = -(-self.size // MODULUS)
        sampled = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()  # place (p // 13, which of 4)
        sampled = sampled[:np.searchsorted(sampled, self.size)]
        count, step = len(sampled), len(COVER)
        first = self.words[sampled[:, None] + np.arange(MODULUS)].astype(">u4")
        _, ranks = np.unique(np.ascontiguousarray(first).view(f"S{4 * MODULUS}").ravel(), return_inverse=True)
        levels = [np.concatenate([ranks + 1, [0]])]
        while ranks.max(initial=0) + 1 < count:
            shift = step << len(levels) - 1
            after = levels[-1][np.minimum(np.arange(count) + shift, count)]
            _, ranks = np.unique(levels[-1][:count] * (count + 1) + after, return_inverse=True)
            levels.append(np.concatenate([ranks + 1, [0]]))
        self.rank = ranks
        order = np.argsort(ranks)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(count - 1, 0), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            own = levels[level][np.minimum(a, count)]
            equal = (own == levels[level][np.minimum(b, count)]) & (own > 0)
            common[equal] += MODULUS << level
            a[equal] += step << level
            b[equal] += step << level
        common += self._few(sampled[order[:-1]] + common, sampled[order[1:]] + common)
        self.minima = [common]
        while 2 << len(self.minima) - 1 <= len(common):
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _few(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from two places on, as far as the modulus; the end of the text equals no word."""
        ahead = np.arange(MODULUS)
        equal = self.words[i[:, None] + ahead] == self.words[j[:, None] + ahead]
        return np.where(equal.all(axis=1), MODULUS, equal.argmin(axis=1))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on; i < j, both within the text or at its end."""
        found = self._few(i, j)
        more = np.flatnonzero(found == MODULUS)
        if len(more):
            if self.rank is None:
                self._sort()
            i, j = i[more], j[more]
            shift = (self.anchor[(j - i) % MODULUS] - i) % MODULUS  # less than the modulus: equal so far
            a, b = self.rank[self._sample(i + shift)], self.rank[self._sample(j + shift)]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp(high - low)[1] - 1
            for k in np.unique(level).tolist():
                own = level == k
                found[more[own]] = shift[own] + np.minimum(self.minima[k][low[own]], self.minima[k][high[own] - (1 << k)])
        return found

    def _sample(self, places: np.ndarray) -> np.ndarray:
        which = np.searchsorted(np.array(COVER), places % MODULUS)
        return places // MODULUS * len(COVER) + which


def _shared_grid() -> list[np.ndarray]:
    """Places and periods of texts up to ``SHARED`` words, in order of the place after both stretches."""
    if not _GRID:
        places, periods = (np.concatenate(x) for x in zip(*_grid(SHARED, 1, SHARED // TIMES + 1), strict=True))
        ends = places + 2 * periods
        order = np.argsort(ends, kind="stable")
        _GRID[:] = [ends[order], places[order], periods[order]]
    return _GRID


def _grid(size: int, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Multiples of 2q from which two stretches of q words fit the text, for periods from low up to high."""
    counts = (size - 2 * np.arange(low, high)) // (2 * np.arange(low, high)) + 1
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        until = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK)), at + 1)
        own = counts[at:until]
        periods = np.repeat(np.arange(low + at, low + until), own)
        steps = np.arange(len(periods)) - np.repeat(np.cumsum(own) - own, own)
        yield 2 * steps * periods, periods
        at = until


def _pairs(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if size > SHARED:
        yield from _grid(size, 1, size // TIMES + 1)
        return
    ends, places, periods = _shared_grid()
    until = int(np.searchsorted(ends, size, "right"))
    yield places[:until], periods[:until]


def find_runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, period, length) of all runs, by start and then period, of words numbered from 1 up.

    A run is a longest stretch with a smallest period q, of at least 6 words and 4q.
    """
    size, found, there, back = len(words), [np.zeros((0, 3), np.int64)], None, None
    for places, periods in _pairs(size):
        keep = np.flatnonzero((words[places] == words[places + periods]) & (TIMES * periods <= size))
        i, q = places[keep], periods[keep]
        for part in (4, 2, 1, 3):  # quarters of the period
            ahead = i + np.maximum(q * part // 4 - 1, 0)
            keep = words[ahead] == words[ahead + q]
            i, q = i[keep], q[keep]
        if not len(i):
            continue
        if there is None:
            there, back = Extensions(words), Extensions(words[::-1])
        right = there.of(i, i + q)
        i, q, right = (x[right >= q] for x in (i, q, right))
        left = back.of(size - i - q, size - i)
        start, length = i - left, left + q + right
        keep = length >= np.maximum(WORDS, TIMES * q)
        found.append(_smallest(start[keep], q[keep], length[keep]))
    runs = _smallest(*np.concatenate(found).T)
    return runs[np.lexsort([runs[:, 1], runs[:, 0]])]


def _smallest(start: np.ndarray, period: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period: whatever has a multiple of a period comes up with the period, too."""
    order = np.lexsort([period, length, start])
    rows = np.stack([start, period, length], axis=1)[order]
    new = np.r_[True, (rows[1:, [0, 2]] != rows[:-1, [0, 2]]).any(axis=1)][:len(rows)]
    return rows[new]


def left_over(size: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when each run is cut down to its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 1], 1)
    np.add.at(change, runs[:, 0] + runs[:, 2], -1)
    return np.cumsum(change[:-1]) == 0


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 1 up."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words), 1)}
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def periodic_runs(docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Runs of each text: doc_id, runs (start, length, period), collapsed.

    Words are what ASCII white space separates, compared byte by byte. Runs come by start, then period.
    ``collapsed`` has the words, joined by single spaces, without those that some run
    contains after its first period. ``edit`` may replace a document's words beforehand.
    A null, empty or blank text has no words, no runs and an empty collapsed text. Rows
    that repeat come out as often as they come in, a null doc_id is carried along, other
    columns are not read, and an empty table gives no rows. Each text is handled whole by
    itself; memory grows with the longest text, not with the table.
    """
    bound_batches(docs.sparkSession)
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            counts, lists, texts = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_buffer().to_pybytes().split()  # for bytes just the ASCII white space
                words = edit(doc, words) if edit else words
                runs = find_runs(numbered(words)) if len(words) >= WORDS else np.zeros((0, 3), np.int64)
                if len(runs):
                    words = [word for word, stays in zip(words, left_over(len(words), runs).tolist(), strict=True) if stays]
                counts.append(len(runs))
                lists.append(runs)
                texts.append(b" ".join(words).decode())
            flat = np.concatenate(lists) if lists else np.zeros((0, 3), np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            found = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in (0, 2, 1)], fields=list(item))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, found), pa.array(texts, pa.string())],
                                             ["doc_id", "runs", "collapsed"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")


def planted(doc: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of all documents, by a checksum of their id, with their words repeated periodically from some place on.

    A document without an id stays as it is.
    """
    checksum = crc32(str(doc).encode())
    if doc is None or checksum % 10 or not words:
        return words
    seed, size = checksum // 10, len(words)
    start = seed % size
    period = 1 + (size - start) // (3 + seed % 8)
    stretch = words[start:start + period]
    return words[:start] + (stretch * (-(-(size - start) // period)))[:size - start]


def summarised(found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_runs, the run of the greatest exponent (start, length, period,
    exponent_milli), and digests of all runs and of the collapsed text.

    Exponents are compared exactly, as fractions; of equals the least start, then period, counts.
    """
    def better(best, run):
        more, same = run.length * best.period - best.length * run.period, (run.start < best.start) | (
            (run.start == best.start) & (run.period < best.period))
        return F.when(best.isNull() | (more > 0) | ((more == 0) & same), run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))), "")
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
