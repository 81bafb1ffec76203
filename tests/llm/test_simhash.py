import random

import numpy as np
import pytest
import xxhash

from duolect.llm.graph import components
from duolect.llm.simhash import BLOCK, CROWD, fingerprint, keep_one, links, near_duplicates


def plain(text, words=4):
    parts = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    if not parts:
        return 0
    own = [b" ".join(parts[i:i + words]) for i in range(max(len(parts) - words + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in own]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def grouped(fps, bits=4):
    """Root of every fingerprint by comparing all pairs."""
    fps = np.array(sorted(fps), np.int64)
    root = {int(x): int(x) for x in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[i + 1:][np.bitwise_count(fps[i + 1:] ^ x) <= bits]:
            a, b = top(int(x)), top(int(y))
            root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


@pytest.mark.parametrize("text", ["", " \n", "One", "a B c", "a B c d", "the same the same the same the same", "Ä ä É x y z", "w " * 300])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain(text)


def test_fingerprint_of_a_long_text_is_that_of_the_whole(monkeypatch):
    text = " ".join(str(random.Random(i).random()) for i in range(500))
    whole = fingerprint(text.encode())
    monkeypatch.setattr("duolect.llm.simhash.CHUNK", 7)
    assert fingerprint(text.encode()) == whole == plain(text)


@pytest.mark.parametrize("block", [BLOCK, 40])
def test_links_connect_just_what_all_pairs_connect(spark, monkeypatch, block):
    rng = random.Random(block)
    monkeypatch.setattr("duolect.llm.simhash.BLOCK", block)
    monkeypatch.setattr("duolect.llm.simhash.CROWD", min(CROWD, block // 10))
    centres = [rng.getrandbits(64) for _ in range(40)]
    values = set(centres)
    for size, centre in zip([600, 60, *[6] * 38], centres, strict=True):
        for _ in range(size):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5)))
            values.add(centre ^ flips)
    fps = {v - (1 << 64) if v >> 63 else v for v in values}
    want = grouped(fps)
    found = links(spark.createDataFrame([(v,) for v in fps], "fp long")).collect()
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") >= 0 and want[r.a] == want[r.b] for r in found)
    roots = {r.node: r.root for r in components(spark.createDataFrame(found, "a long, b long")).collect()}
    assert all(roots.get(v, v) == want[v] for v in fps)


def test_components_of_paths_hubs_and_loops(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    found = components(spark.createDataFrame([*path, *hub, (5, 5), (2000, 1999), (1999, 2000)], "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots) and {roots[i] for i in range(61)} == {0}
    assert {roots[1000 + i] for i in range(300)} == {1000} and roots[2000] == roots[1999] == 1999
    assert components(spark.createDataFrame([(5, 5)], "a long, b long")).count() == 0


def test_odd_rows(odd):
    rows = odd.collect()
    roots = grouped({plain(r.text) for r in rows})
    least = {}
    for r in rows:
        if r.doc_id is not None:
            root = roots[plain(r.text)]
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{plain(r.text) & (1 << 64) - 1:016x}", least.get(roots[plain(r.text)])) for r in rows]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in near_duplicates(odd).collect())
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    best = {}
    for r in rows:
        if r.doc_id is not None and least[roots[plain(r.text)]] == r.doc_id:
            own = f"{plain(r.text) & (1 << 64) - 1:016x}"
            best[r.doc_id] = min(best.get(r.doc_id, own), own)
    stay = kept.collect()
    assert sorted((r.doc_id, f"{plain(r.text) & (1 << 64) - 1:016x}") for r in stay if r.doc_id is not None) == sorted(best.items())
    assert [r.doc_id for r in stay].count(None) == 2


def test_of_one_id_with_two_texts_only_the_copy_goes(make):
    text = "one two three four five six seven eight nine ten"
    rows = make([(1, text), (2, text), (2, "quite another text that has nothing to do with it"), (3, "yet another one about other things"), (3, "yet another one about other things")])
    assert sorted((r.doc_id, r.text[:5]) for r in keep_one(rows).collect()) == [(1, "one t"), (2, "quite"), (3, "yet a")]


def test_empty_table(odd):
    assert near_duplicates(odd.limit(0)).count() == keep_one(odd.limit(0)).count() == 0
