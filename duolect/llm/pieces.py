"""SentencePiece encoding and decoding of texts of any length, by a max-plus scan.

The encoding of a text is the one path of pieces over it in which every two neighbours
are encoded as themselves when they stand alone: merges only ever join neighbours, so
what two pieces do does not depend on the rest. As a max-plus product, a pair weighs
minus infinity if it is not like that, and each piece weighs minus one, so that a
path's weight is its number of pieces.

A giant text is cut into chunks. Each chunk gives a transfer matrix from the pieces
that may lie across its left edge to those that may lie across its right edge. Max-plus
products of neighbours are formed in rounds, the best path is traced back over the edges
alone, from the last round to the first, and then every chunk is encoded by itself between
its two known pieces. A text of one chunk has no inner edge: it is the library's. Between words no
piece can cross, so all that is done piece by piece is the word an edge cuts, and the
rest of a chunk is encoded by the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duolect.llm.common import Remembered, bound_batches, held, packed, same, whole
from duolect.session import materialize

CHUNK = 1 << 15
KNOWN_WORDS = 250_000
# Neighbouring matrices that one task multiplies or traces.
FAN = 64
# The format's mark for a space, and a private character that no vocabulary has.
SPACE = "▁"
ALONE = "\ue000"
# A piece across an edge: its text, and how many of its characters lie beyond. Between words there is none.
State = tuple[str, int]
NONE: State = ("", 0)
# Entry, exit and weight wherever a path leads through.
Matrix = list[tuple[State, State, int]]


class Coder:
    """A vocabulary, and what has been learnt about its words and pairs."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(self.model.get_piece_size())
        special = lambda i: self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)
        self.bytes = [b"" if special(i) else bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                      else self.model.id_to_piece(i).encode() for i in numbers]
        self.pieces = {self.model.id_to_piece(i) for i in numbers if not special(i) and not self.model.is_byte(i)}
        self.longest = max(map(len, self.pieces))
        if any(SPACE in p.lstrip(SPACE) or ALONE in p for p in self.pieces):
            raise ValueError("a piece of this vocabulary may cross from one word into the next")
        self.skip = len(self.model.encode(ALONE))
        self.words = Remembered(lambda words: map(packed, self.model.encode(words)), KNOWN_WORDS)
        self.own: dict[str, list[int]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def alone(self, text: str) -> list[int]:
        """Ids of a stretch of text as it is, without the space put before a whole text."""
        if text not in self.own:
            if len(self.own) >= KNOWN_WORDS:
                self.own.clear()
            self.own[text] = self.model.encode(ALONE + text)[self.skip:]
        return self.own[text]

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces next to each other are encoded as themselves."""
        if not left:
            return True
        if (left, right) not in self.pairs:
            if len(self.pairs) >= KNOWN_WORDS:
                self.pairs.clear()
            self.pairs[left, right] = self.model.encode(ALONE + left + right)[self.skip:] == self.alone(left) + self.alone(right)
        return self.pairs[left, right]

    def starting(self, text: str, at: int) -> Iterator[str]:
        """The pieces that may start here; a character without a piece is one by itself."""
        for size in range(1, min(self.longest, len(text) - at) + 1):
            piece = text[at:at + size]
            if size == 1 or piece in self.pieces and len(self.alone(piece)) == 1:
                yield piece

    def stretch(self, text: str) -> bytes:
        """Ids of whole words, the first one's space included."""
        words = text[1:].split(SPACE)
        if "" in words or len(text) == 1:
            return packed(self.model.encode(text[1:]) if len(text) > 1 else self.alone(text))
        return self.words.of(words)

    def wholes(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, the mark before each one included."""
        found = self.model.encode([text[1:] for text in texts], num_threads=1)
        return [packed(ids) if len(text) != 1 else packed(self.alone(text)) for text, ids in zip(texts, found, strict=True)]

    def decode(self, ids: bytes) -> str:
        """The stretch of text that ids stand for, spaces marked."""
        return b"".join(self.bytes[i] for i in memoryview(ids).cast("I")).decode("utf-8", "replace")


def coder(path: str) -> Coder:
    """The worker's own coder of a file."""
    return held("pieces", path, Coder)


def between(text: str, at: int) -> bool:
    """Whether a word ends before ``at`` and another one starts there; so does the text, and it ends so."""
    return at <= 0 or at >= len(text) or text[at] == SPACE and text[at - 1] != SPACE


class Paths:
    """Paths over ``text`` from ``start``, after a piece that ends there, across ``stop``."""

    def __init__(self, known: Coder, text: str, start: int, before: str, stop: int):
        self.start = start
        # By where a piece ends: each piece that a path may end with there, and the piece before it.
        self.ends: dict[int, dict[str, str]] = {start: {before: ""}}
        for at in range(start, stop):
            for piece in known.starting(text, at) if at in self.ends else ():
                left = next((p for p in self.ends[at] if known.fits(p, piece)), None)
                if left is not None:
                    self.ends.setdefault(at + len(piece), {})[piece] = left

    def trace(self, end: int, piece: str) -> list[str]:
        """The pieces of the path that ends with ``piece`` at ``end``."""
        found = []
        while end > self.start:
            found.append(piece)
            end, piece = end - len(piece), self.ends[end][piece]
        return found[::-1]


class Chunk:
    """A stretch of a text between two edges, with enough of what is around it to see across them."""

    def __init__(self, known: Coder, left: str, body: str, right: str):
        self.known, self.text = known, left + body + right
        self.left, self.right = len(left), len(left) + len(body)
        at = self.left
        inner = [self.left] if between(self.text, self.left) else []
        while (at := self.text.find(SPACE, at + 1)) != -1 and at < self.right:
            if between(self.text, at):
                inner.append(at)
        if self.right == len(self.text) or between(self.text, self.right):
            inner.append(self.right)
        self.first, self.last = (inner[0], inner[-1]) if inner else (None, None)

    def entries(self) -> list[State]:
        """The pieces that may lie across or end at the left edge."""
        if self.first == self.left:
            return [NONE]
        return [(piece, start + len(piece) - self.left) for start in range(max(self.left - self.known.longest, 0), self.left)
                for piece in self.known.starting(self.text, start) if start + len(piece) >= self.left]

    def exits(self, paths: Paths) -> dict[State, int]:
        """The states at the right edge that paths lead to, with their number of pieces."""
        return {(piece, end - self.right): len(paths.trace(end, piece)) for end, found in paths.ends.items() if end >= self.right
                for piece in found if end - len(piece) < self.right and end > paths.start}

    def matrix(self) -> Matrix:
        """Entry, exit and weight (minus the number of pieces that start within) wherever a path leads."""
        known, found = self.known, []
        tail: dict[State, int] = {}
        if self.last is not None:
            tail = {NONE: 0} if self.last == self.right else self.exits(Paths(known, self.text, self.last, "", self.right))
        for piece, over in self.entries():
            start = self.left + over
            if self.first is None or start > self.first:
                if start >= self.right:  # the piece reaches beyond this chunk
                    found.append(((piece, over), (piece, start - self.right), 0))
                elif self.first is None:
                    found += [((piece, over), to, -n) for to, n in self.exits(Paths(known, self.text, start, piece, self.right)).items()]
                continue
            paths = Paths(known, self.text, start, piece, self.first)
            ends = [p for p in paths.ends.get(self.first, {}) if start < self.first] if start < self.first else [piece]
            for end in ends[:1]:
                head = len(paths.trace(self.first, end)) if start < self.first else 0
                middle = len(known.stretch(self.text[self.first:self.last])) // 4 if self.last > self.first else 0
                found += [((piece, over), to, -(head + middle + n)) for to, n in tail.items()]
        return found

    def encode(self, entry: State, leave: State) -> bytes:
        """Ids of the pieces that start in this chunk, between two known pieces."""
        known, start, end = self.known, self.left + entry[1], self.right + leave[1]
        if start >= self.right:
            return b""
        if self.first is None:
            return self._ids(Paths(known, self.text, start, entry[0], self.right).trace(end, leave[0]))
        found = b""
        if start < self.first:
            paths = Paths(known, self.text, start, entry[0], self.first)
            found += self._ids(paths.trace(self.first, next(iter(paths.ends[self.first]))))
        if self.last > self.first:
            found += known.stretch(self.text[self.first:self.last])
        if self.last < self.right:
            found += self._ids(Paths(known, self.text, self.last, "", self.right).trace(end, leave[0]))
        return found

    def _ids(self, pieces: list[str]) -> bytes:
        return b"".join(packed(self.known.alone(p)) for p in pieces)

    def covered(self, entry: State, leave: State) -> str:
        """The text of the pieces that start in this chunk."""
        return self.text[self.left + entry[1]:max(self.right + leave[1], self.left + entry[1])]


def product(first: Matrix, second: Matrix) -> Matrix:
    """The max-plus product: the best weight from each entry of the first to each exit of the second.

    It is associative: matrices of neighbouring chunks may be multiplied in any grouping.
    """
    onward: dict[State, list[tuple[State, int]]] = {}
    for entry, leave, weight in second:
        onward.setdefault(entry, []).append((leave, weight))
    best: dict[tuple[State, State], int] = {}
    for entry, between_, weight in first:
        for leave, more in onward.get(between_, ()):
            best[entry, leave] = max(best.get((entry, leave), -(1 << 62)), weight + more)
    return [(entry, leave, weight) for (entry, leave), weight in best.items()]


def through(matrices: list[Matrix], entry: State = NONE, leave: State = NONE) -> list[State]:
    """The states at all edges of the best path through the matrices between two known ones."""
    best: dict[State, int] = {entry: 0}
    steps: list[dict[State, State]] = []
    for matrix in matrices:
        after: dict[State, int] = {}
        step: dict[State, State] = {}
        for start, end, weight in matrix:
            if start in best and best[start] + weight > after.get(end, -(1 << 62)):
                after[end], step[end] = best[start] + weight, start
        best = after
        steps.append(step)
    states = [leave]
    for step in reversed(steps):
        states.append(step[states[-1]])
    return states[::-1]


def _chunks(docs: DataFrame, chunk: int, margin: int) -> DataFrame:
    """doc_id, text_hash, chunk, chunks, and the chunk with its margins, spaces marked."""
    text = F.col("text")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.when(text == "", text).otherwise(F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))).alias("text"))
    count = F.greatest(F.ceil(F.length("text") / chunk), F.lit(1)).cast("int")
    rows = marked.withColumn("chunks", count).select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    at = F.col("chunk") * chunk

    def part(start: Column, size: Column) -> Column:
        return F.substring(text, start + 1, size)

    before = F.least(at, F.lit(margin))
    return rows.select("doc_id", "text_hash", "chunk", "chunks", part(at - before, before).alias("left"),
                       part(at, F.lit(chunk)).alias("body"), part(at + chunk, F.lit(margin)).alias("right"))


def _edges(chunks: DataFrame, model: str) -> DataFrame:
    """Entry and exit of each chunk of the texts that have several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(model)
        for batch in batches:
            found = [json.dumps(Chunk(known, *parts).matrix())
                     for parts in zip(*(batch.column(c).to_pylist() for c in ("left", "body", "right")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.string())], ["doc_id", "text_hash", "chunk", "matrix"])

    level = materialize(chunks.select("doc_id", "text_hash", "chunk", "left", "body", "right").mapInArrow(
        run, "doc_id long, text_hash long, chunk int, matrix string"), "pieces-matrices")
    return _scan(level)


def _scan(matrices: DataFrame, fan: int = FAN) -> DataFrame:
    """Entry and exit of every chunk from the matrices of all: a parallel scan.

    Going up, the matrices of ``fan`` neighbours are multiplied into one, until a text has
    at most that many; the best path through these fixes the states at their edges. Going
    down, each group finds the states within it. No task has more than ``fan`` matrices of a text.
    """
    last = matrices.agg(F.max("chunk")).first()[0]
    levels = [matrices]
    while (last or 0) >= fan:
        last //= fan
        grouped = levels[-1].withColumn("block", F.floor(F.col("chunk") / fan).cast("int")).groupBy("doc_id", "text_hash", "block")
        levels.append(materialize(grouped.applyInPandas(_multiplied, "doc_id long, text_hash long, chunk int, matrix string"), "pieces-products"))
    none = F.lit(json.dumps(NONE))
    states = "doc_id long, text_hash long, chunk int, entry string, leave string"
    tops = levels[-1].select("*", F.lit(0).alias("block"), none.alias("from"), none.alias("to"))
    found = tops.groupBy("doc_id", "text_hash", "block").applyInPandas(_traced, states)
    for level in reversed(levels[:-1]):
        above = materialize(found, "pieces-states").select(
            "doc_id", "text_hash", F.col("chunk").alias("block"), F.col("entry").alias("from"), F.col("leave").alias("to"))
        own = level.withColumn("block", F.floor(F.col("chunk") / fan).cast("int"))
        where = same(F.col("own.doc_id"), F.col("above.doc_id")) & (F.col("own.text_hash") == F.col("above.text_hash")) & (
            F.col("own.block") == F.col("above.block"))
        joined = own.alias("own").join(above.alias("above"), where).select("own.*", "from", "to")
        found = joined.groupBy("doc_id", "text_hash", "block").applyInPandas(_traced, states)
    return found


def _in_order(group: pd.DataFrame) -> tuple[pd.DataFrame, list[Matrix]]:
    """A group's matrices in order; rows that repeat a text give it once."""
    group = group.drop_duplicates("chunk").sort_values("chunk")
    return group, [[(tuple(a), tuple(b), w) for a, b, w in json.loads(m)] for m in group["matrix"]]


def _multiplied(group: pd.DataFrame) -> pd.DataFrame:
    group, matrices = _in_order(group)
    return group.head(1).assign(chunk=group["block"].iloc[0], matrix=json.dumps(reduce(product, matrices))).drop(columns="block")


def _traced(group: pd.DataFrame) -> pd.DataFrame:
    group, matrices = _in_order(group)
    ends = (tuple(json.loads(group[c].iloc[0])) for c in ("from", "to"))
    states = through(matrices, *ends)
    return group[["doc_id", "text_hash", "chunk"]].assign(
        entry=[json.dumps(s) for s in states[:-1]], leave=[json.dumps(s) for s in states[1:]])


def encode(docs: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """Encode every text: doc_id, chunk, chunks, ids, restored.

    ``ids`` are those of the pieces that start in the chunk, as little-endian unsigned
    32-bit bytes; a text's chunks in order give the library's ids of the whole.
    ``restored`` says whether they decode to the stretch of text they stand for. A null
    or empty text is one chunk without ids. A text that holds the mark U+2581 itself
    decodes with spaces there, as with the library. Rows that repeat come out as often
    as they come in; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    margin = coder(model).longest
    chunks = _chunks(docs, chunk, margin)
    several = chunks.where("chunks > 1")
    edges = materialize(_edges(several, model), "pieces-edges").withColumnsRenamed({"doc_id": "doc", "text_hash": "hash", "chunk": "number"})
    names = ["doc_id", "chunk", "chunks", "left", "body", "right", "entry", "leave"]
    here = same(F.col("doc_id"), F.col("doc")) & (F.col("text_hash") == F.col("hash")) & (F.col("chunk") == F.col("number"))
    none = F.lit(json.dumps(NONE))
    known = several.join(edges, here).select(*names).unionByName(
        chunks.where("chunks = 1").select(*names[:-2], none.alias("entry"), none.alias("leave")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model)
        for batch in batches:
            parts = list(zip(*(batch.column(c).to_pylist() for c in names[3:]), strict=True))
            wholes = iter(own.wholes([body for left, body, right, *_ in parts if not (left or right)]))
            ids, restored = [], []
            for left, body, right, entry, leave in parts:
                if not (left or right):  # one chunk: the only path through it is the library's
                    ids.append(next(wholes))
                    restored.append(own.decode(ids[-1]) == body)
                    continue
                part, at = Chunk(own, left, body, right), (tuple(json.loads(entry)), tuple(json.loads(leave)))
                ids.append(part.encode(*at))
                restored.append(own.decode(ids[-1]) == part.covered(*at))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.binary()), pa.array(restored, pa.bool_())],
                                             ["doc_id", "chunk", "chunks", "ids", "restored"])

    return known.mapInArrow(run, "doc_id long, chunk int, chunks int, ids binary, restored boolean")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, chunk and the text of each chunk's ids; a text is its chunks' in order.

    The space before a whole text is taken off again. Each chunk is decoded by itself.
    """
    bound_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model)
        for batch in batches:
            texts = [own.decode(ids).replace(SPACE, " ")[1 if chunk == 0 else 0:]
                     for chunk, ids in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "chunk", "text"])

    return encoded.select("doc_id", "chunk", "ids").mapInArrow(run, "doc_id long, chunk int, text string")
