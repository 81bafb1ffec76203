"""Hard negatives: for each anchor and positive, the best rows of other labels in a window of scores.

Scores are integer inner products of all rows with the anchors. Anchors and candidates
are dealt out by hash into blocks of bounded size, and each block of anchors meets each
block of candidates in one task, which multiplies tiles of int64 by Strassen's recursion
and keeps, for every anchor, bounded heaps of the best scores. Heaps merge: the best of
all tiles are among the best of each, so only their few entries are shuffled on, first
for the positives, then for the windows that the positives open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duolect.session import materialize

# Anchors, and candidates, of one block. A task holds one block of each.
BLOCK = 4096
# Anchors and candidates of a tile.
TILE = (256, 2048)
# Sides from which on a product is split.
LEAF = 32
# Scores are less than this, so that a score and a place in a block fit a 64-bit key.
SCORE_LIMIT = 1 << 48
NOTHING = np.iinfo(np.int64).min
HEAP_ROWS = "anchor_id long, slot int, other_id long, score long"


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices by Strassen's seven products of half the size.

    Odd sides get a row or column of zeros. Sums wrap round in 64 bits, where they form a
    ring: the result is exact whenever the true one fits, whatever the sums between.
    """
    (rows, inner), columns = a.shape, b.shape[1]
    if min(rows, inner, columns) < LEAF:
        return _leaf(a, b)
    a = np.pad(a, ((0, rows % 2), (0, inner % 2))) if rows % 2 or inner % 2 else a
    b = np.pad(b, ((0, inner % 2), (0, columns % 2))) if inner % 2 or columns % 2 else b
    r, i, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b11, b12, b21, b22 = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    out = np.empty((2 * r, 2 * c), np.int64)
    c11, c12, c21, c22 = out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:]
    c11[:] = c22[:] = product(a11 + a22, b11 + b22)
    c21[:] = part = product(a21 + a22, b11)
    c22 -= part
    c12[:] = part = product(a11, b12 - b22)
    c22 += part
    part = product(a22, b21 - b11)
    c11 += part
    c21 += part
    part = product(a11 + a12, b22)
    c11 -= part
    c12 += part
    c22 += product(a21 - a11, b11 + b12)
    c11 += product(a12 - a22, b21 + b22)
    return out[:rows, :columns]


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A plain product; in doubles where every sum of products is below 2^53 and so exact."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    peak = max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) * a.shape[1]
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if peak < 1 << 53 else a @ b


def merged(heap: np.ndarray, more: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` largest keys of two heaps, in ascending order."""
    return np.sort(np.concatenate([heap, more]))[-size:] if len(heap) else more


class Block:
    """Ids, labels and vectors of a block, sorted by label."""

    def __init__(self, rows: pa.Table, width: int):
        order = np.lexsort([rows["vec_id"].to_numpy(), rows["label"].to_numpy()])
        self.ids, self.labels = rows["vec_id"].to_numpy()[order], rows["label"].to_numpy()[order]
        vectors = rows["vector"].combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        matrix = np.zeros((len(order), width), np.int64)
        matrix[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy()  # shorter vectors end in zeros
        self.matrix = matrix[order]
        self.order = order


def best_of(anchors: Block, candidates: Block, low: np.ndarray, high: np.ndarray, size: int, same: bool,
            tile: tuple[int, int] = TILE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For every anchor and window the best candidates of its label, or of other labels.

    ``low`` and ``high`` are the bounds of each anchor's windows, both included. Gives
    the anchor's place, the window's, ids and scores, best first; an anchor is not its own candidate.
    """
    count = len(candidates.ids)
    by_id = np.argsort(candidates.ids, kind="stable")
    places = np.empty(count, np.int64)
    places[by_id] = np.arange(count - 1, -1, -1)  # smaller ids come first among equals: they get the larger key
    turned = candidates.matrix.T
    for at in range(0, len(anchors.ids), tile[0]):
        rows = slice(at, at + tile[0])
        labels, ids = anchors.labels[rows], anchors.ids[rows]
        heaps = [[np.zeros(0, np.int64)] * low.shape[1] for _ in labels]
        start, end = 0, count
        if same:  # candidates lie in order of their labels
            start, end = np.searchsorted(candidates.labels, labels[0]), np.searchsorted(candidates.labels, labels[-1], "right")
        for a in range(start, end, tile[1]):
            own = slice(a, min(a + tile[1], end))
            keys = product(anchors.matrix[rows], turned[:, own]) * count + places[own]
            equal = labels[:, None] == candidates.labels[own]
            keys[(~equal if same else equal) | (ids[:, None] == candidates.ids[own])] = NOTHING
            keys.sort(axis=1)
            for row, heap in enumerate(heaps):
                begins = np.searchsorted(keys[row], low[at + row] * count)
                ends = np.searchsorted(keys[row], high[at + row] * count + count - 1, "right")
                for slot, (begin, past) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
                    if past > begin:
                        heap[slot] = merged(heap[slot], keys[row, max(begin, past - size):past], size)
        for row, heap in enumerate(heaps):
            for slot, own in enumerate(heap):
                if len(own):
                    scores, place = np.divmod(own[::-1], count)
                    yield at + row, slot, candidates.ids[by_id[count - 1 - place]], scores


def _search(anchors: DataFrame, rows: DataFrame, size: int, same: bool, width: int, blocks: tuple[int, int]) -> DataFrame:
    """The heaps of every pair of blocks (anchor_id, slot, other_id, score).

    ``anchors`` has the windows' bounds in arrays ``low`` and ``high``.
    """
    def run(some: pa.Table, others: pa.Table) -> pa.Table:
        found = []
        if some.num_rows and others.num_rows:
            block, windows = Block(some, width), len(some["low"][0])
            low, high = (some[c].combine_chunks().flatten().to_numpy().reshape(-1, windows)[block.order] for c in ("low", "high"))
            for at, slot, ids, scores in best_of(block, Block(others, width), low, high, size, same):
                found.append((np.full(len(ids), block.ids[at]), np.full(len(ids), slot, np.int32), ids, scores))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor_id", "slot", "other_id", "score"])

    def dealt(df: DataFrame, own: str, number: int, other: str, others: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    left = dealt(anchors, "_anchors", blocks[0], "_rows", blocks[1]).groupBy("_anchors", "_rows")
    right = dealt(rows, "_rows", blocks[1], "_anchors", blocks[0]).groupBy("_anchors", "_rows")
    return left.cogroup(right).applyInArrow(run, HEAP_ROWS)


def _merge(heaps: DataFrame, size: int) -> DataFrame:
    """The first ``size`` of every anchor and slot, numbered from 1 in ``rank``; each task merges its own heaps first."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "other_id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def quantised(vector: str | Column, scale: int = 256) -> Column:
    """Components as whole numbers: ``floor(scale * x)``, x as double; null for a null vector,
    and for one with a null or non-finite component."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    doubles = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(sound, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10,
         least: int = 30, most: int = 90, block: int = BLOCK) -> DataFrame:
    """Hard negatives of the rows (vec_id, label, vector) whose vec_id is divisible by ``every``.

    ``vector`` is an array of whole numbers; a shorter one counts as filled up with
    zeros. A score is the inner product with the anchor; higher ones come first, then
    the smaller vec_id. An anchor's positives are its first ``positives`` other rows of
    the same label. For each the first ``negatives`` rows of other labels come back whose
    score is between ``least`` and ``most`` hundredths of the positive's: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score. Where a
    positive's score is negative no score is, so it has no negatives.

    Rows with a null in vec_id, label, vector or a component take no part; of rows that repeat a vec_id the
    one with the least label, then vector, does. Other columns are not read. An empty
    table, or one without anchors, gives no rows. Vectors so large that a score might reach
    2^48 are refused with a ValueError.
    """
    if not 0 <= least <= most <= 100:
        raise ValueError("the bounds are hundredths, the lower one first")
    spark = rows.sparkSession
    whole = rows.where("vec_id is not null and label is not null and vector is not null").where(
        F.forall("vector", lambda x: x.isNotNull()))
    unique = whole.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"))).alias("own"))
    unique = materialize(unique.select("vec_id", "own.label", "own.vector"), "negatives-rows")
    is_anchor = F.col("vec_id") % every == 0
    size = F.greatest(F.array_max("vector"), -F.array_min("vector"))
    total, n_anchors, width, peak = unique.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max(F.size("vector")), F.max(size)).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], result)
    if (peak or 0) ** 2 * width >= SCORE_LIMIT:
        raise ValueError(f"scores of vectors with components up to {peak} may not fit")
    blocks = (-(-n_anchors // block), -(-total // block))
    limit = F.lit(SCORE_LIMIT).cast("long")
    anchors = unique.where(is_anchor)
    open_to_all = anchors.withColumns({"low": F.array(-limit), "high": F.array(limit)})
    found = materialize(_merge(_search(open_to_all, unique, positives, True, width, blocks), positives).select(
        "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "negatives-positives")
    # Whole n with 100 * n >= least * p and 100 * n <= most * p; the window of a negative or lacking positive is empty.
    entries = F.map_from_entries(F.collect_list(F.struct("slot", "positive_score")))
    scores = found.groupBy("anchor_id").agg(entries.alias("scores")).select("anchor_id", F.array(*[
        F.coalesce(F.element_at("scores", F.lit(slot)), F.lit(-1).cast("long")) for slot in range(positives)]).alias("scores"))
    windows = materialize(anchors.join(scores, F.col("vec_id") == F.col("anchor_id")).withColumns({
        "low": F.expr(f"transform(scores, p -> if(p < 0, {SCORE_LIMIT}L, (p * {least} + 99) div 100))"),
        "high": F.expr(f"transform(scores, p -> if(p < 0, -{SCORE_LIMIT}L, (p * {most}) div 100))")}).drop("anchor_id", "scores"), "negatives-windows")
    best = _merge(_search(windows, unique, negatives, False, width, blocks), negatives)
    return best.join(found, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
