"""Packing documents into as few sequences as it can: dominance reduction, then best fit.

Documents are tokenised, and only those longer than a sequence are cut. The pieces are
dealt out evenly into groups of bounded size; one task packs each. It first fixes the
sequences that some best packing of the group must not do without: a longest piece with
at most two others, where every other way to fill up its sequence is dominated, that is,
could be exchanged for this one without using a sequence more. Each sequence so fixed
shrinks the group and may make others certain. What remains is packed by best fit, longest
piece first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolect.llm.packing import pieces
from duolect.session import materialize

WINDOW = 4096
# Pieces that one task packs. A group leaves at most a sequence or so that a larger one would not need.
GROUP_PIECES = 1 << 16
PLACES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Stock:
    """Numbered pieces still to be packed, by length; the bits of ``present`` are the lengths there are."""

    def __init__(self, lengths: list[int], window: int):
        self.waiting: list[list[int]] = [[] for _ in range(window + 1)]
        for number in range(len(lengths) - 1, -1, -1):
            self.waiting[lengths[number]].append(number)
        self.counts = [len(own) for own in self.waiting]
        self.present = sum(1 << length for length, own in enumerate(self.waiting) if own)

    def change(self, length: int, by: int) -> None:
        self.counts[length] += by
        if self.counts[length] == (by > 0):
            self.present ^= 1 << length

    def take(self, length: int) -> int:
        self.change(length, -1)
        return self.waiting[length].pop()

    def longest(self, most: int) -> int:
        """The greatest length there is, up to ``most``; 0 without any."""
        return max((self.present & ((1 << most + 1) - 1)).bit_length() - 1, 0) if most > 0 else 0

    def shortest(self, count: int, above: int = 0) -> list[int]:
        """The least lengths beyond ``above``, as often as they come, ``count`` in all at most."""
        found, rest = [], self.present >> above + 1 << above + 1
        while rest and len(found) < count:
            low = rest & -rest
            length = low.bit_length() - 1
            found += [length] * min(self.counts[length], count - len(found))
            rest ^= low
        return found

    def descending(self) -> Iterator[int]:
        length = self.longest(len(self.counts) - 1)
        while length:
            yield length
            length = self.longest(length - 1)

    def best_pair(self, room: int) -> tuple[int, int]:
        """Two pieces that fill the room best, the longer first; of equals the pair with the longest."""
        best, first = (0, 0), self.longest(room)
        while first and 2 * first > sum(best):
            self.change(first, -1)
            second = self.longest(min(first, room - first))
            self.change(first, 1)
            if second and first + second > sum(best):
                best = (first, second)
            first = self.longest(first - 1)
        return best


def companions(stock: Stock, length: int, window: int) -> tuple[int, ...] | None:
    """What to put with a piece of this length, where no other choice can be better; None if that is open.

    The piece must be a longest one of the stock and is not in it any more.
    """
    room = window - length
    least = stock.shortest(3)
    if not least or least[0] > room:
        return ()
    mate = stock.longest(room)
    if mate == room or len(least) == 1 or least[0] + least[1] > room:
        return (mate,)  # nothing fits better than the longest that fits, and nothing beside it
    if len(least) == 3 and sum(least) <= room:
        return None  # three or more may fit: too many choices to compare
    first, second = stock.best_pair(room)
    if mate >= first + second:
        return (mate,)
    if mate == first:
        stock.change(first, -1)
        between = stock.shortest(2, above=second)
        stock.change(first, 1)
        if len(between) < 2 or sum(between) > room:
            return first, second  # of any other pair the longer is at most the first, the shorter at most the second
    return None


def reduce(stock: Stock, window: int) -> list[list[int]]:
    """Take the sequences out of the stock that dominate all others with their longest piece, until there are none."""
    fixed, before = [], -1
    while len(fixed) != before:
        before = len(fixed)
        for length in stock.descending():
            while stock.counts[length]:
                stock.change(length, -1)
                found = companions(stock, length, window)
                stock.change(length, 1)
                if found is None:
                    break
                fixed.append([stock.take(own) for own in (length, *found)])
    return fixed


def best_fit(stock: Stock, window: int) -> list[list[int]]:
    """Pack what is in the stock, longest first, each piece into the open sequence with the least room for it."""
    packed: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = 0
    for length in stock.descending():
        while stock.counts[length]:
            piece = stock.take(length)
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                number = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                room, number = window, len(packed)
                packed.append([])
            packed[number].append(piece)
            if room > length:
                by_room[room - length].append(number)
                rooms |= 1 << room - length
    return packed


def arrange(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each length; no length is below 1 or beyond the window."""
    stock = Stock(lengths, window)
    numbers, offsets = [0] * len(lengths), [0] * len(lengths)
    for number, own in enumerate(reduce(stock, window) + best_fit(stock, window)):
        at = 0
        for piece in own:
            numbers[piece], offsets[piece] = number, at
            at += lengths[piece]
    return numbers, offsets


def place(cut: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add piece, sequence_id and offset to pieces (see ``pack``), group by group.

    Pieces are dealt out by a hash of their row, so groups are even whatever the
    documents are like. Rows are stored first: a lost executor changes no group.
    """
    rows = materialize(cut.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id())), "reduced-pieces")
    groups = max(-(-rows.count() // group_pieces), 1)
    dealt = rows.select("doc_id", (F.col("start") / window).cast("int").alias("piece"), "start", "length", "ids_crc32",
                        F.pmod(F.col("_deal"), F.lit(groups)).alias("_group"))

    def pack_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        numbers, offsets = arrange(group["length"].tolist(), window)
        return group.drop(columns="_group").assign(sequence_id=[(int(key[0]) << 32) + n for n in numbers], offset=offsets)

    return dealt.groupBy("_group").applyInPandas(pack_group, PLACES)


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pack documents: one row per piece, with its sequence and its place there.

    Gives doc_id, piece (from 0), start, length, ids_crc32 (of the ids as little-endian
    unsigned 32-bit numbers), sequence_id, offset. Only a document of more than
    ``window`` ids, ``end_id`` included, has more than one piece; all but its last are
    full sequences by themselves. A null or empty text is its end id alone. A null doc_id
    is carried along, rows that repeat are packed as often as they come, other columns
    are not read, and an empty table gives no rows.
    """
    return place(pieces(docs, tokenizer, end_id, window), window, group_pieces)
