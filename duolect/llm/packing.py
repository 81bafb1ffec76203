"""Packing documents into training sequences by best-fit decreasing.

Documents are tokenised and cut: every full window is a sequence by itself, and the
remainders are dealt out evenly into groups of bounded size, each of which one task
packs. A segment tree indexed by remaining capacity finds the tightest open window.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from unicodedata import is_normalized
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolect.llm.common import Remembered, bound_batches, held, let_go, packed, slabs, whole
from duolect.session import materialize

WINDOW = 2048
# Pieces that one task packs; so many leave hardly any padding.
GROUP_PIECES = 1 << 16
# Distinct words whose ids a worker remembers, to twice as many; some 300 bytes each.
KNOWN_WORDS = 400_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACES = PIECES + ", sequence_id long, offset long"
# Python splits at the first four, which the tokenizer does not count as white space, and lowers the others by what is around them.
ODD = re.compile("[\x1c-\x1f\u03a3\u0130]")
WORD_END = re.compile(r"[.,](?<=[a-z\xdf-\xf6\xf8-\xff].)(?=\s|$)")


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by words seen before.

    The tokenizer lowers case and never looks across white space, nor from a letter to
    the point or comma that ends a word, so a text's ids are those of these parts one
    after another; most of them have been seen already.
    """

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many workers as there are cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Remembered(self._learn, known_words)

    def _learn(self, words: list[str]) -> Iterator[bytes]:
        return (packed(found.ids) for found in self.tokenizer.encode_batch_fast(words, add_special_tokens=False))

    def encode(self, text: str) -> bytes:
        if ODD.search(text):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if "<|" not in text and is_normalized("NFC", text):
            text = WORD_END.sub(r" \g<0>", text.lower())
        return b"".join(self.words.of(part.split()) for part in slabs(text))


def word_ids(path: str, known_words: int = KNOWN_WORDS) -> WordIds:
    """The worker's own tokenizer of a file."""
    return held(f"ids of {known_words} words", path, lambda path: WordIds(path, known_words))


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, with_ids: bool = False,
           known_words: int = KNOWN_WORDS) -> DataFrame:
    """Each document's ids and ``end_id``, cut into full windows and a remainder.

    Gives doc_id, start, length, ids_crc32, doc_tokens, and with ``with_ids`` the ids
    themselves as little-endian unsigned 32-bit bytes.
    """
    bound_batches(docs.sparkSession)
    end = end_id.to_bytes(4, "little")
    kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer, known_words)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = words.encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    own = ids[4 * start:4 * (start + window)]
                    rows.append((doc, start, len(own) // 4, crc32(own), total, own)[:len(kinds)])
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    schema = PIECES + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")).mapInArrow(run, schema)


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree of their numbers."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.tree[at] += by
            at >>= 1

    def add(self, number: int, room: int) -> None:
        self.windows[room].append(number)
        self._count(room, 1)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the window with the least room for ``size``: its number and room."""
        at, tree = size + self.leaves, self.tree
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._count(room, -1)
        return self.windows[room].pop(), room


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each length; the lengths come in decreasing order."""
    windows, numbers, offsets, used = OpenWindows(window), [], [], 0
    for length in lengths:
        found = windows.tightest(length)
        if found is None:
            found = (used, window)
            used += 1
        number, room = found
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            windows.add(number, room - length)
    return numbers, offsets


def place(cut: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces: no sequence is longer than the window.

    Pieces are dealt out by a hash of their row, so groups are even whatever the
    documents are like, and no group has many more than ``group_pieces`` pieces.
    """
    rows = materialize(cut.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id())), "packing-pieces")
    groups = max(-(-rows.count() // group_pieces), 1)
    dealt = rows.withColumn("_group", F.pmod(F.col("_deal"), F.lit(groups))).drop("_deal")

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        let_go()
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        numbers, offsets = best_fit(group["length"].tolist(), window)
        return group.drop(columns="_group").assign(sequence_id=[(int(key[0]) << 32) + n for n in numbers], offset=offsets)

    return dealt.groupBy("_group").applyInPandas(pack, PLACES)


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, group_pieces: int = GROUP_PIECES,
         known_words: int = KNOWN_WORDS) -> DataFrame:
    """Pack documents: one row per piece, with its sequence and its place there.

    Gives doc_id, start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    numbers), doc_tokens (with the end id), sequence_id, offset. A null or empty text
    is its end id alone. A null doc_id is carried along, rows that repeat are packed as
    often as they come, other columns are not read, and an empty table gives no rows.
    ``known_words`` trades a worker's memory for time; the result does not depend on it.
    """
    return place(pieces(docs, tokenizer, end_id, window, known_words=known_words), window, group_pieces)


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, ids (bytes as in ``pieces``), length.

    ``with_ids`` are the same documents' pieces with their ids; doc_id must be unique.
    """
    joined = placed.join(with_ids.select("doc_id", "start", "ids"), ["doc_id", "start"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    rows = joined.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
    empty = F.lit(b"")
    return rows.select("sequence_id", F.aggregate("parts", empty, lambda a, x: F.concat(a, x["ids"])).alias("ids"), "length")
