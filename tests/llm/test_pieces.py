import random

import public_tokenizers
import pytest

from duolect.llm import pieces
from duolect.llm.pieces import NONE, SPACE, Chunk, Paths, coder, decode, encode, product, through

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["the", "in", "er", " ", "  ", "a", "ab", "的", "中", "日本", "🙂", "é", "\n", "ooo", "aaaa", "'s", "https://", "==", "ing", "tion",
         "1", "23", " t", "\t", SPACE, "́", "xxxxx"]


def by_chunks(text, chunk):
    known = coder(PATH)
    marked = text and SPACE + text.replace(" ", SPACE)
    cuts = range(0, len(marked), chunk)
    chunks = [Chunk(known, marked[max(i - known.longest, 0):i], marked[i:i + chunk], marked[i + chunk:i + chunk + known.longest]) for i in cuts]
    states = through([c.matrix() for c in chunks])
    found = [c.encode(*at) for c, at in zip(chunks, zip(states, states[1:], strict=False), strict=True)]
    assert all(known.decode(ids) == c.covered(*at) for ids, c, at in zip(found, chunks, zip(states, states[1:], strict=False), strict=True))
    return list(memoryview(b"".join(found)).cast("I"))


@pytest.mark.parametrize("chunk", [3, 7, 20])
def test_chunks_of_any_size_give_the_librarys_ids(chunk):
    rng = random.Random(chunk)
    for _ in range(150):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        assert by_chunks(text, chunk) == coder(PATH).model.encode(text), repr(text)


def test_weights_count_pieces():
    known, text = coder(PATH), SPACE + "unbelievablylongwordwithoutspaces"
    whole = Chunk(known, "", text, "")
    assert [w for _, _, w in whole.matrix()] == [-len(known.model.encode(text[1:]))]
    paths = Paths(known, text, 0, "", len(text))
    assert len(paths.ends[len(text)]) == 1  # one path covers a text


def test_tables_and_round_trip(spark, make):
    rng = random.Random(9)
    words = ["alpha", "beta,", "gamma\n", "δέλτα", "🙂", "x" * 40, ""]
    docs = make([(i, " ".join(rng.choices(words, k=rng.choice([3, 80, 900])))) for i in range(25)] + [(50, "y" * 5000)])
    encoded = encode(docs, PATH, chunk=500)
    ids, texts = {}, {}
    for r in sorted(encoded.select("doc_id", "chunk", "ids").collect()):
        ids.setdefault(r.doc_id, []).extend(memoryview(bytes(r.ids)).cast("I"))
    for r in sorted(decode(encoded, PATH).collect()):
        texts[r.doc_id] = texts.get(r.doc_id, "") + r.text
    for r in docs.collect():
        assert ids[r.doc_id] == coder(PATH).model.encode(r.text) and texts[r.doc_id] == r.text
    assert encoded.where("not restored").count() == 0 and encoded.where("chunks > 1").count() > 20


def test_odd_rows(odd):
    rows = encode(odd, PATH, chunk=20_000).collect()
    assert sum(r.chunk == 0 for r in rows) == odd.count()
    assert all(bytes(r.ids) == b"" for r in rows if r.doc_id in (0, 1)) and all(r.restored for r in rows)
    assert encode(odd.limit(0), PATH).count() == 0


def matrices_of(text, chunk):
    known, marked = coder(PATH), SPACE + text.replace(" ", SPACE)
    return [Chunk(known, marked[max(i - known.longest, 0):i], marked[i:i + chunk], marked[i + chunk:i + chunk + known.longest]).matrix()
            for i in range(0, len(marked), chunk)]


def test_products_in_any_grouping_are_the_walk_from_left_to_right():
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(10, 60)))
        matrices = matrices_of(text, 5)
        want = [w for a, b, w in matrices_product(matrices, 0, len(matrices), None) if a == NONE]
        for _ in range(4):
            assert sorted(w for a, b, w in matrices_product(matrices, 0, len(matrices), rng) if a == NONE) == sorted(want)
        assert max(want) == -len(coder(PATH).model.encode(text))


def matrices_product(matrices, low, high, rng):
    if high - low == 1:
        return matrices[low]
    cut = rng.randint(low + 1, high - 1) if rng else high - 1
    return product(matrices_product(matrices, low, cut, rng), matrices_product(matrices, cut, high, rng))


def test_scan_in_rounds_gives_the_states_of_one_walk(spark, make, monkeypatch):
    rng = random.Random(6)
    docs = make([(i, "".join(rng.choice(PARTS) for _ in range(rng.choice([2, 90, 400])))) for i in range(12)] + [(None, "no id " * 90), (3, "another " * 80)])
    want = sorted((str(r.doc_id), r.chunk, bytes(r.ids)) for r in encode(docs, PATH, chunk=17).collect())
    scan = pieces._scan
    monkeypatch.setattr(pieces, "_scan", lambda matrices: scan(matrices, fan=3))
    assert sorted((str(r.doc_id), r.chunk, bytes(r.ids)) for r in encode(docs, PATH, chunk=17).collect()) == want
