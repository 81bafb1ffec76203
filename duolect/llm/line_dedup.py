"""Substring deduplication by hashed lines, cut at sentence ends.

A unit is a sentence, or the rest of a line: a repeated passage inside an otherwise
different line or paragraph is still made of whole units. Units are normalised and
hashed, digests are grouped over all documents, the earliest occurrence stays and the
others are cut out. A line of fewer than ``MIN_WORDS`` words is one unit, with a digest of
its own. A sentence as short inside a longer line means little by itself; its digest
covers the words before it too, so it only counts as repeated along with them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolect.llm.common import FILTER_SETTINGS, SPACES, bound_batches, boxed, let_go, matched, same, settings, unboxed, whole
from duolect.session import materialize

MIN_WORDS = 8
LINE = re.compile(r"[^\n]*\n|[^\n]+")
UNIT_END = re.compile(r"[.!?]\s")
UNITS = "doc_id long, text_hash long, unit int, start int, stop int, key binary"
BETWEEN = r"[\x20\x09-\x0D]+"
# Units handed back at a time.
ROWS = 20_000


def units(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, bytes | None]]:
    """Start and end (code points) and digest of each unit, blank ones left out.

    The digest is of the lower-case words. It is None for a short sentence of a longer
    line with too few words before it, which only a text's first words can have.
    """
    before: list[str] = []
    for line in LINE.finditer(text):
        at, last = line.span()
        short = len(line[0].split()) < min_words
        ends = [] if short else [m.end() for m in UNIT_END.finditer(text, at, last)]
        for end in [*ends, last]:
            words = text[at:end].lower().split()
            if words:
                own = words if short or len(words) >= min_words else (before + words)[-min_words:]
                full = short or len(own) >= min_words
                yield at, end, blake2b(" ".join(own).encode("utf-8", "surrogatepass"), digest_size=16).digest() if full else None
                before = (before + words)[-min_words:] if len(words) < min_words else words[-min_words:]
            at = end


def _unit_rows(docs: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        names = ["doc_id", "text_hash", "unit", "start", "stop", "key"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for doc, known, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for number, (start, stop, key) in enumerate(units(text, min_words)):
                    if key is not None:
                        rows.append((doc, known, number, start, stop, key))
                    if len(rows) >= ROWS:
                        yield out()
                        rows.clear()
        yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), whole("text").alias("text")).mapInArrow(run, UNITS)


def _text_hash():
    return F.xxhash64(whole("text"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The spans to cut: doc_id, text_hash, starts, stops, one row per document that has any.

    Documents rank by doc_id, a null id last, then by the hash of their text; units by
    their place. Offsets count code points of the original text from zero.
    """
    bound_batches(docs.sparkSession)
    rows = materialize(_unit_rows(docs, min_words), "lines-units", digests=["key"])
    total = rows.count()
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "unit")
    first = materialize(rows.groupBy("key").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1"),
                        "lines-repeated", digests=["key"])
    found = matched(rows, first, "key", "size", total)
    later = found.where(~(same(F.col("doc_id"), F.col("found.first.doc_id")) & (F.col("text_hash") == F.col("found.first.text_hash"))
                          & (F.col("unit") == F.col("found.first.unit"))))
    spans = later.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    return spans.select("doc_id", "text_hash", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))


def cut(text: str, starts: list[int], stops: list[int]) -> str:
    """The text without the spans, which do not overlap and are in order."""
    kept = zip([0, *stops], [*starts, len(text)], strict=True)
    return "".join(text[a:b] for a, b in kept)


def _cut_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """The rows of ``docs`` in a struct ``row``, the text that is left, and ``starts`` and ``stops`` of what was cut."""
    with settings(docs.sparkSession, FILTER_SETTINGS):
        found = materialize(repeated_spans(docs, min_words), "lines-spans").withColumnsRenamed({"doc_id": "doc", "text_hash": "hash"})
    joined = (boxed(docs, F.col("doc_id").cast("long").alias("own_id"), _text_hash().alias("own_hash"))
              .join(found, same(F.col("own_id"), F.col("doc")) & (F.col("own_hash") == F.col("hash")), "left")
              .select("row", F.col("row.text").alias("rest"), "starts", "stops"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            row, rest, starts, stops = batch.columns
            texts = [text if a is None or text is None else cut(text, a, b)
                     for text, a, b in zip(rest.to_pylist(), starts.to_pylist(), stops.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([row, pa.array(texts, rest.type), starts, stops], batch.schema.names)

    return joined.mapInArrow(run, joined.schema)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text and removed of every row: the text without its repeated units, and what was cut.

    ``removed`` is an array of start and stop in the original text, empty where nothing
    was cut; such texts come out as they are. Null texts stay null. Rows that repeat both id and text are cut
    alike and come out as often as they come in. Other columns are not read.
    """
    kind = "array<struct<start:int,stop:int>>"
    spans = F.arrays_zip(F.col("starts").alias("start"), F.col("stops").alias("stop")).cast(kind)
    return _cut_rows(docs.select("doc_id", "text"), min_words).select(
        F.col("row.doc_id").alias("doc_id"), F.col("rest").alias("text"), F.coalesce(spans, F.array().cast(kind)).alias("removed"))


def keep_rest(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with repeats cut, ``n_chars`` counted anew.

    Documents of which nothing but white space is left go; those without text before stay,
    and so do, uncut, those of fewer than ``MIN_WORDS`` words: whole copies of these are the
    concern of the stages before.
    """
    rest = _cut_rows(docs, MIN_WORDS)
    emptied = F.col("starts").isNotNull() & (F.length(F.translate(whole("rest"), SPACES, "")) == 0)
    brief = F.size(F.split(F.btrim(whole("row.text"), F.lit(SPACES)), BETWEEN)) < MIN_WORDS
    text = F.when(emptied, F.col("row.text")).otherwise(F.col("rest"))
    return unboxed(rest.where(~emptied | brief), docs, text=text, n_chars=F.length(text).cast("long"))
