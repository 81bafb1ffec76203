import random

import numpy as np

from duolect.llm.toxicity import Model, fit, score_toxicity, sentences


def labelled(make, spark, n=500):
    rng = random.Random(4)
    plain = ["ocean", "garden", "window", "music", "letter", "summer", "table", "stone"]
    rows, marks = [], []
    for i in range(n):
        parts = [" ".join(rng.choices(plain, k=6)) for _ in range(rng.randint(1, 9))]
        toxic = i % 5 == 0
        if toxic:
            at = rng.randrange(len(parts))
            parts[at] = f"{parts[at]} {rng.choice(['grumbolt', 'snarkfish'])}"
        rows.append((i, ". ".join(parts) + "."))
        marks.append((i, 1, int(toxic)))
    return make(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_score_is_noisy_or_of_its_sentences():
    model = Model({"bad": 3.0, "^awfu": 2.0}, -2.0)
    p = lambda raw: 1 / (1 + np.exp(-raw))
    score, spans = model.score("A bad day. Awfully bad. Nothing.")
    assert np.isclose(score, 1 - (1 - p(1)) * (1 - p(3)) * (1 - p(-2)))
    assert [(a, b) for a, b, _ in spans] == [(0, 9), (10, 22)] and np.isclose(spans[1][2], p(3))
    assert model.score("") == (0.0, []) and model.score("... !") == (0.0, [])


def test_fit_finds_the_feature_that_makes_a_bag_positive():
    rng = np.random.default_rng(0)
    labels, bags, rest = [], [], []
    for _ in range(400):
        own = [[int(x)] for x in rng.integers(1, 6, rng.integers(1, 5))]
        label = rng.random() < 0.3
        if label:
            own[rng.integers(len(own))] = [0, 3]
        labels.append(float(label)), bags.append(own), rest.append(2.0)
    weights, bias = fit(np.array(labels), bags, np.array(rest), 6)
    assert weights.argmax() == 0 and weights[0] + bias > 0 > bias + weights[1:].max()


def test_held_out_documents_and_the_sentence_at_fault(spark, make):
    docs, labels = labelled(make, spark)
    rows = score_toxicity(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").where("held_out").collect()
    assert len(rows) > 50 and all(r.predicted == r.toxic for r in rows)
    for r in rows:
        bad = [(a, b) for a, b, words in sentences(r.text) if words & {"grumbolt", "snarkfish"}]
        assert [(s.start, s.end) for s in r.sentences] == bad


def test_real_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits / sum(r.predicted for r in rows) > 0.9 and hits / sum(r.toxic for r in rows) > 0.8  # so few to learn from


def test_odd_rows_and_labels(spark, make, odd):
    docs, labels = labelled(make, spark)
    rows = score_toxicity(docs.unionByName(odd), labels).collect()
    assert len(rows) == docs.count() + odd.count() and all(0 <= r.score <= 1 for r in rows)
    none = score_toxicity(odd, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert score_toxicity(odd.limit(0), labels).count() == 0
