import hashlib
import re

from pyspark.sql import functions as F

from duolect.llm.syncmers import anchors, as_text, compare_edits, likeness, marks


def edited(rows):
    """Text and edit of each document in order, by the definition."""
    found = {}
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        found[doc] = (len(text), text[:len(text) - quarter] + after[:quarter])
    return found


def test_anchors_are_the_closed_syncmers(spark):
    text = "a b  c\nd e f g a b c d e z y x w v u a b c d e f g"
    words = re.split(r"[\x20\x09-\x0D]+", text)
    pairs = [r.h for r in spark.createDataFrame([(i, words[i], words[i + 1]) for i in range(len(words) - 1)], "i int, a string, b string")
             .orderBy("i").select(F.xxhash64("a", "b").alias("h")).collect()]
    want = [i for i in range(len(words) - 4) if min(pairs[i:i + 4]) in (pairs[i], pairs[i + 3])]
    got = spark.createDataFrame([(text,)], "text string").select(anchors(F.col("text")).alias("a")).first().a
    assert [x.place for x in got] == want and 0.2 < len(want) / (len(words) - 4) < 0.9


def test_same_words_give_the_same_anchors_in_any_context(spark):
    core = " ".join(f"w{i * i % 97}" for i in range(60))
    rows = spark.createDataFrame([(0, core), (1, "other words here " + core + " and more after it")], "i int, text string")
    one, two = [{x.hash for x in r.a} for r in rows.orderBy("i").select(anchors(F.col("text")).alias("a")).collect()]
    assert one <= two


def test_edits_and_likeness(spark, make):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.orderBy("doc_id").collect()]
    want, got = edited(rows), {r.doc_id: r for r in compare_edits(docs.repartition(7)).collect()}
    assert got.keys() == want.keys()
    for doc, (n, text) in want.items():
        assert (got[doc].n_chars, got[doc].edited_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
        assert 0 <= got[doc].near_edited <= 1 and 0 <= got[doc].near_next <= 1
    by_text = {}
    for doc, text in rows:
        by_text.setdefault(text, set()).add(got[doc].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    nearer = [r for r in got.values() if r.n_chars > 200]
    assert sum(r.near_edited > r.near_next for r in nearer) / len(nearer) > 0.97
    prints = {doc: listed(got[doc].fingerprint) for doc, _ in rows}
    for i, (doc, _) in enumerate(rows):
        own, new, after = prints[doc], listed(got[doc].edited_fingerprint), prints[rows[(i + 1) % len(rows)][0]]
        assert got[doc].near_edited == jaccard(own, new) and got[doc].near_next == jaccard(own, after)


def listed(fingerprint):
    return [fingerprint[i:i + 16] for i in range(0, len(fingerprint), 16)]


def jaccard(one, other):
    one, other = set(one), set(other)
    return len(one & other) / len(one | other) if one | other else 1.0


def test_anchors_out_of_order_or_at_other_distances_match_less(spark):
    parts = [" ".join(f"p{i}w{i * j % 97}" for j in range(30)) for i in range(1, 9)]
    texts = [" ".join(parts), " ".join(["new words come first", *parts]), " ".join(reversed(parts)),
             " ".join(w + " so" * (n % 40 == 39) for n, w in enumerate(" ".join(parts).split()))]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(
        "i", F.transform(anchors(F.col("text")), lambda x: x["hash"]).alias("bag"), marks(F.col("text")).alias("marks"))
    first = rows.where("i = 0").select(F.col("marks").alias("m"), F.col("bag").alias("b"))
    near = {r.i: (r.near, r.bag) for r in rows.crossJoin(first).select(
        "i", likeness(F.col("marks"), F.col("m")).alias("near"), likeness(F.array_distinct("bag"), F.array_distinct("b")).alias("bag")).collect()}
    assert near[0] == (1, 1) and near[1][0] > 0.95  # a shift of all places changes nothing but the start
    assert near[2][0] < near[2][1] < 1 and near[2][0] < near[1][0] and near[3][0] < near[0][0]


def test_the_list_is_anchor_next_anchor_and_distance_in_order(spark):
    text = " ".join(f"w{i * i % 31}" for i in range(80))
    row = spark.createDataFrame([(text,)], "text string").select(anchors(F.col("text")).alias("a"), as_text(marks(F.col("text"))).alias("f")).first()
    pairs = spark.createDataFrame([(n, a.hash, b.place - a.place, b.hash) for n, (a, b) in enumerate(zip(row.a, row.a[1:], strict=False))], "n int, a long, d int, b long")
    want = [f"{r.h & (1 << 64) - 1:016x}" for r in pairs.select("n", F.xxhash64("a", "d", "b").alias("h")).orderBy("n").collect()]
    assert listed(row.f) == list(dict.fromkeys(want)) and len(want) > 20


def test_odd_rows(odd):
    rows = compare_edits(odd).collect()
    distinct = {(r.doc_id, r.text or "") for r in odd.collect()}
    assert len(rows) == len(distinct)
    empty = [r for r in rows if r.doc_id in (0, 1)]
    assert all(r.fingerprint == "" and r.edited_fingerprint == "" and r.near_edited == 1 for r in empty)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.edited_sha256) == 64 for r in rows)
    one = compare_edits(odd.where("doc_id = 4")).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"HelloworHe").hexdigest()
    assert compare_edits(odd.limit(0)).count() == 0


def test_a_passage_shared_by_long_texts_counts(spark, make):
    passage = " ".join(f"p{i * i % 89}q{i}" for i in range(40))
    rows = compare_edits(make([(i, " ".join(f"d{i}w{j * j % 991}" for j in range(900)) + " " + passage) for i in range(3)])).collect()
    assert all(0 < r.near_next < 0.1 for r in rows)


def test_texts_of_five_and_six_words_have_anchors(spark, make):
    texts = [" ".join(f"w{i}n{n}at{j}" for j in range(n)) for i in range(40) for n in (5, 6)]
    found = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(anchors(F.col("text")).alias("a")).collect()
    assert all(r.a for r in found) and len({tuple(x.hash for x in r.a) for r in found}) == len(texts)
    rows = compare_edits(make([*enumerate(texts), (1000, "")])).collect()
    assert all(r.near_next == 0 and (r.fingerprint or r.doc_id == 1000) for r in rows)
