"""Runs against a search of all periods, extensions against word-by-word comparison, the query against a plain walk."""

import hashlib
import random
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duolect.llm import runs as R
from duolect.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of every run: all stretches that no neighbour extends, of every period."""
    found, numbers = {}, {}
    words = np.array([numbers.setdefault(word, len(numbers)) for word in words])
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate([[0], words[q:] == words[:-q], [0]])
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for s, e in zip(starts.tolist(), (ends + q).tolist(), strict=True):
            if e - s >= max(6, 4 * q):
                found.setdefault((s, e), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), crc32(str(doc).encode())
    g = h // 10
    if doc is not None and h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    milli = best and 1000 * best[1] // best[2]
    return (doc, len(runs), *(best or (None,) * 3), milli,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        words = []
        while len(words) < rng.choice([0, 5, 8, 40, 300]):
            unit = [rng.randint(1, rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([1, 1, 2, 3, 7, 20]))]
            words += (unit * rng.randint(1, 9))[:rng.randint(1, 90)]
        yield np.array(words, np.int64)


@pytest.mark.parametrize("seed", range(5))
def test_runs_are_those_of_a_search_of_all_periods(seed):
    for words in texts(seed, 120):
        assert [(s, n, q) for s, q, n in R.find_runs(words).tolist()] == plain_runs(words.tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 2), max_size=70))
def test_runs_of_two_words(words):
    assert [(s, n, q) for s, q, n in R.find_runs(np.array(words, np.int64)).tolist()] == plain_runs(words)


def test_long_texts_make_their_grid_in_pieces(monkeypatch):
    monkeypatch.setattr(R, "SHARED", 16)
    monkeypatch.setattr(R, "CHUNK", 37)
    monkeypatch.setattr(R, "_GRID", [])
    for words in texts(9, 60):
        assert [(s, n, q) for s, q, n in R.find_runs(words).tolist()] == plain_runs(words.tolist())


def test_extensions_are_those_of_a_comparison_word_by_word():
    rng = random.Random(3)
    for words in texts(4, 60):
        n = len(words)
        if not n:
            continue
        found = R.Extensions(words)
        i, j = np.array([sorted(rng.sample(range(n + 1), 2)) for _ in range(50)]).T
        want = [next((t for t in range(n) if b + t >= n or words[a + t] != words[b + t]), n) for a, b in zip(i, j, strict=True)]
        assert found.of(i, j).tolist() == want


def test_every_difference_is_covered():
    assert {(b - a) % R.MODULUS for a in R.COVER for b in R.COVER} == set(range(R.MODULUS))


def test_query_is_a_plain_walk(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = {plain_row(r.doc_id, r.text) for r in docs.collect()}
    rows = QUERIES["op13_runs"](spark, SMALL)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {tuple(r) for r in rows.collect()} == want and sum(r[1] > 0 for r in want) > 15


def test_odd_rows(make, odd):
    more = make([(20, "a " * 5), (21, "a " * 6), (22, "a\x1cb " * 6 + "é " * 9), (23, "x y " * 4 + "x"), (24, "x y\x0bx\fy " * 3 + "x y z z z z z z")])
    rows = odd.unionByName(more)
    found = R.summarised(R.periodic_runs(rows, R.planted))
    assert sorted(map(str, (plain_row(r.doc_id, r.text) for r in rows.collect()))) == sorted(str(tuple(r)) for r in found.collect())


def test_runs_and_collapsed_text(make):
    row = R.periodic_runs(make([(1, "so it  goes goes goes goes goes goes on a b a b a b a b end")])).first()
    assert [tuple(r) for r in row.runs] == [(2, 6, 1), (9, 8, 2)] and row.collapsed == "so it goes on a b end"


def test_empty_table(odd):
    assert R.summarised(R.periodic_runs(odd.limit(0))).count() == 0
