import random
from collections import defaultdict
from zlib import crc32

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from duolect.llm import packing
from duolect.llm.common import packed
from duolect.llm.packing import best_fit, pack, pieces, sequences, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_takes_the_tightest_window(lengths):
    lengths.sort(reverse=True)
    numbers, offsets = best_fit(lengths, 64)
    room = []
    for length, number, offset in zip(lengths, numbers, offsets, strict=True):
        fitting = [r for r in room if r >= length]
        if number == len(room):
            assert not fitting and offset == 0
            room.append(64)
        else:
            assert room[number] == min(fitting) and offset == 64 - room[number]
        room[number] -= length


def test_ids_by_words_are_the_tokenizers():
    own, whole = word_ids(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(5)
    parts = ["the", "don't", "É", "é", "123", "<|endoftext|>", "\x1c", "\xa0", " ", "日本", "ΑΣ", "..", "🙂", "\n", "\t", "İ", "'ll", "E\u0301", "End.", "###,", "a,b", "ß.", "Word,", "ΟΔΟΣ", "<|ENDOFTEXT|>", "ǅ"]
    for _ in range(400):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(0, 12)))
        assert own.encode(text) == packed(whole.encode(text, add_special_tokens=False).ids), repr(text)


def test_odd_rows_are_packed_without_gaps(odd):
    rows = pack(odd, PATH, end_id=1, window=64, group_pieces=200).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for r in odd.collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]
        want += [(r.doc_id, at, len(ids[at:at + 64]), crc32(packed(ids[at:at + 64])), len(ids)) for at in range(0, len(ids), 64)]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in rows)
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for own in windows.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 64


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = [r.n for r in pack(docs, PATH, 1).groupBy("sequence_id").sum("length").toDF("s", "n").collect()]
    assert sum(sizes) / (2048 * len(sizes)) > 0.99


def test_sequences_hold_the_ids(make):
    docs = make([(i, "some words " * i) for i in range(20)])
    with_ids = pieces(docs, PATH, 1, window=16, with_ids=True)
    placed = packing.place(pieces(docs, PATH, 1, window=16), window=16)
    found = {r.sequence_id: bytes(r.ids) for r in sequences(placed, with_ids).collect()}
    for r in placed.join(with_ids.select("doc_id", "start", "ids"), ["doc_id", "start"]).collect():
        assert found[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(map(len, found.values())) == 4 * placed.groupBy().sum("length").first()[0]


def test_empty_table(odd):
    assert pack(odd.limit(0), PATH, 1).count() == 0


def test_ids_do_not_depend_on_the_words_remembered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    few, many = (sorted(map(tuple, pack(docs, PATH, 1, **more).select(*names).collect())) for more in ({"known_words": 50}, {}))
    assert few == many
