"""SimHash near-duplicates, found by a range join over segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits, and each segment is mapped
to its number of ones. Two fingerprints differ in at least as many bits as their
counts differ in all, so Manhattan distance of the counts is a lower bound. Of k <= 5
differing bits, one half of the fingerprint holds at most two; in that half the counts
are at most two steps apart, and some point of the grid is at most one step from both.
Every fingerprint therefore goes to the grid points within one step of either half's
counts; fingerprints that meet there are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from duolect.llm.common import attach, bound_batches, boxed, let_go, unboxed, whole
from duolect.llm.graph import components
from duolect.session import materialize

SEED = 42
CHUNK = 1 << 16  # shingles hashed at a time
EVEN_BITS = 0x55555555
# Fingerprints of one grid point that are compared in one go; more are split into blocks, and pairs of blocks compared.
BLOCK = 4096
# Fingerprints with the same counts from which on their grid points may need to be split.
CROWD = 64
# Grid points within a step of a half's counts, itself included.
NEAR = 33


def fingerprint(text: bytes, words: int = 4) -> int:
    """SimHash of a text's word shingles as a signed 64-bit number."""
    parts = text.lower().split()  # for bytes both know ASCII only
    if not parts:
        return 0
    count = max(len(parts) - words + 1, 1)
    if count == 1:
        hashes = iter([[xxhash.xxh64_intdigest(b" ".join(parts), SEED)]])
    else:
        hashes = _hashes(parts, words)
    ones = np.zeros(64, np.int64)
    for some in hashes:
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def _hashes(parts: list[bytes], words: int) -> Iterator[list[int]]:
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(parts) - words + 1, CHUNK):
        some = parts[at:at + CHUNK + words - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(x) + 1 for x in some])
        starts = (ends - [len(x) + 1 for x in some]).tolist()
        yield [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist(), strict=False)]


def fingerprinted(rows: DataFrame, words: int = 4) -> DataFrame:
    """All columns of ``rows`` but the last, its text as bytes, and ``fp`` instead."""
    bound_batches(rows.sparkSession)
    schema = StructType([*rows.schema.fields[:-1], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            values = [fingerprint(text.as_buffer().to_pybytes(), words) for text in batch.columns[-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id and fp, one row per document."""
    return fingerprinted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").cast("binary").alias("text")), words)


def _counts(fp: Column, half: int) -> Column:
    """The grid point of a half: 16 two-bit fields, each the ones in a segment, and the half."""
    bits = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
    return bits - F.shiftright(bits, 1).bitwiseAND(F.lit(EVEN_BITS)) + F.lit(half << 32)


def _steps(point: Column) -> Column:
    """The grid points at most one step away."""
    near = [point]
    for at in range(0, 32, 2):
        ones = F.shiftright(point, at).bitwiseAND(F.lit(3))
        near += [F.when(ones < 2, point + F.lit(1 << at)), F.when(ones > 0, point - F.lit(1 << at))]
    return F.array_compact(F.array(*near))


def _meetings(distinct: DataFrame) -> DataFrame:
    """cell, part, fp: those with the same cell and part are to be compared."""
    points = distinct.select("fp", F.explode(F.array(_counts(F.col("fp"), 0), _counts(F.col("fp"), 1))).alias("point"))
    crowds = points.groupBy("point").count().where(F.col("count") >= CROWD)
    split = materialize(crowds.select("count", F.explode(_steps(F.col("point"))).alias("split_cell")).groupBy("split_cell")
                        .agg(F.ceil((F.sum("count") + NEAR * CROWD) / BLOCK).cast("int").alias("blocks")).where("blocks > 1"),
                        "simhash-split")
    rows = points.select("fp", F.explode(_steps(F.col("point"))).alias("cell"))
    rows = rows.join(split, F.col("cell") == F.col("split_cell"), "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    parts = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(own, other) * F.col("blocks") + F.greatest(own, other)))
    return rows.select("cell", F.explode(parts).alias("part"), "fp")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node to the least node it is linked with: the same components, fewer links."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.split(ends, 2)
    root, before = np.arange(len(nodes)), None
    while before is None or (root != before).any():
        before = root.copy()
        least = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], least)
        np.minimum.at(root, root[y], least)
        root = root[root]
    return nodes[root != np.arange(len(nodes))], nodes[root][root != np.arange(len(nodes))]


def _pairs(group: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in the same group that differ in at most so many bits; groups lie together."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    found_a, found_b = [], []
    for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        own = fps[start:start + size]
        for at in range(0, size, 256):
            i, j = np.nonzero(np.bitwise_count(own[at:at + 256, None] ^ own[None, :]) <= bits)
            keep = i + at < j
            found_a.append(own[i[keep] + at])
            found_b.append(own[j[keep]])
    small = np.repeat(sizes <= 64, sizes)
    left = np.repeat(starts + sizes, sizes)
    at, step = np.flatnonzero(small), 1
    while len(at := at[at + step < left[at]]):
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= bits]
        found_a.append(fps[near])
        found_b.append(fps[near + step])
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """Links (a, b) that connect just the fingerprints within ``bits`` of each other.

    A task compares the fingerprints that meet at a grid point and hands on a spanning
    forest, so a large group of near copies gives about as many links as members.
    """
    if bits > 5:
        raise ValueError("grid points one step away are enough for at most 5 differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        rest = (np.zeros(0, np.int64),) * 3
        for batch in _then_none(batches):
            if batch is not None:
                rest = tuple(np.concatenate([old, batch.column(i).to_numpy()]) for i, old in enumerate(rest))
            cell, part, fps = rest
            if not len(cell):
                continue
            change = np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])]
            done = len(cell) if batch is None else int(np.flatnonzero(change)[-1])  # the last group may go on
            rest = tuple(x[done:] for x in rest)
            if done:
                a, b = _forest(*_pairs(np.cumsum(change[:done]), fps[:done], bits))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    met = _meetings(distinct)
    return (met.repartition("cell", "part").sortWithinPartitions("cell", "part").mapInArrow(run, "a long, b long"))


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id.

    Words are what ASCII white space separates, A-Z in lower case; shingles are taken
    with repeats, a text of fewer words is one shingle, and null, empty or blank texts
    have fingerprint zero, which is linked like any other. ``component_id`` is the
    smallest doc_id that links of at most ``bits`` differing bits lead to. Rows without
    a doc_id link others but give no id: a component of such rows only has a null id.
    Repeated rows come out as often as they come in; other columns are not read.
    """
    rows = materialize(fingerprints(docs, words), "simhash-rows")
    total = rows.count()
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size")),
                           "simhash-distinct")
    roots = materialize(components(links(distinct.select("fp"), bits)), "simhash-roots")
    # A component may hold very many fingerprints, and those without links have no root: their keys differ.
    rooted = materialize(distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "size", F.col("root").isNull().alias("alone"),
        F.coalesce(F.col("root").cast("string"), F.concat(F.lit("alone "), F.col("fp").cast("string"))).alias("key")), "simhash-rooted")
    named = rooted.where("not alone").groupBy("key").agg(F.min("least").alias("name"), F.count(F.lit(1)).alias("members"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    names = materialize(attach(rooted, named, "key", "members", rooted.count(), ["fp"]).select(
        hexed.alias("fingerprint"), F.when(F.col("alone"), F.col("least")).otherwise(F.col("found.name")).alias("component_id"), "size"),
        "simhash-names")
    return attach(rows.select("doc_id", hexed.alias("fingerprint")), names, "fingerprint", "size", total, ["doc_id"]).select(
        "doc_id", "fingerprint", F.col("found.component_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """The document with the smallest id of each component, with all columns of ``docs``.

    Rows without a doc_id stay. A doc_id may come up with several texts: each goes or
    stays with its own component, and where several of them would stay for one component,
    or a row repeats, the one with the least fingerprint does.
    """
    found = materialize(near_duplicates(docs, words, bits), "simhash-result")
    several = materialize(found.where("doc_id is not null").groupBy(F.col("doc_id").alias("gone")).count().where("count > 1").select("gone"),
                          "simhash-several")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone"))
    boxes = boxed(docs, F.col("doc_id").cast("long").alias("doc_id"), whole("text").cast("binary").alias("text"))
    where = F.col("doc_id") == F.col("gone")
    kept = boxes.drop("text").join(materialize(gone.unionByName(several).distinct(), "simhash-gone"), where, "left_anti").select("row")
    if not several.isEmpty():
        best = found.where("doc_id = component_id").groupBy("doc_id").agg(F.min("fingerprint").alias("least"))
        rows = fingerprinted(boxes.join(several, where, "left_semi").select("row", "doc_id", "text"), words)
        first = (F.col("own.doc_id") == F.col("best.doc_id")) & (F.lpad(F.lower(F.hex("fp")), 16, "0") == F.col("least"))
        once = rows.alias("own").join(best.alias("best"), first, "left_semi").dropDuplicates(["doc_id"])
        kept = kept.unionByName(once.select("row"))
    return unboxed(kept, docs)
