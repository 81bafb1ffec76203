"""Hard negatives: products against plain ones, results against a walk through all rows; the query also has SQL."""

import numpy as np
import pytest

from duolect.llm import hard_negatives as H
from duolect.llm.queries import adjusted

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string, score int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (64, 64, 64), (33, 65, 100), (130, 64, 257), (0, 3, 4), (40, 0, 40)])
@pytest.mark.parametrize("peak", [3, 300, 1 << 30, 1 << 62])
def test_products_are_exact(shape, peak):
    rng = np.random.default_rng(peak)
    rows, inner, columns = shape
    a, b = rng.integers(-peak, peak, (rows, inner)), rng.integers(-peak, peak, (inner, columns))
    assert (H.product(a, b) == a @ b).all()


def plain(rows, every, positives, negatives, least, most):
    """rows: (vec_id, label, vector of whole numbers)."""
    found = []
    for anchor, label, vector in rows:
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, other, strict=False)), i, own == label) for i, own, other in rows if i != anchor)
        for minus, positive, _ in [s for s in scored if s[2]][:positives]:
            fitting = [s for s in scored if not s[2] and least * -minus <= 100 * -s[0] <= most * -minus][:negatives]
            found += [(anchor, positive, rank, i, -minus, -s) for rank, (s, i, _) in enumerate(fitting, 1)]
    return sorted(found)


def vectors(spark, rows):
    return spark.createDataFrame([(i, label, v, 1) for i, label, v in rows], "vec_id long, label int, vector array<long>, score int")


@pytest.mark.parametrize("block", [H.BLOCK, 50, 7])
def test_negatives_are_those_of_a_walk_through_all_rows(spark, monkeypatch, block):
    monkeypatch.setattr(H, "TILE", (4, 16))
    rng = np.random.default_rng(block)
    rows = [(int(i), int(rng.choice([0, 0, 0, 1, 2])), rng.integers(-4, 9, 5).tolist()) for i in rng.permutation(200)]
    rows += [(i, 3 + i % 3, [2, 2, 2, 2, 2]) for i in range(200, 260)]  # copies: all ties
    got = H.mine(vectors(spark, rows), every=10, block=block)
    want = plain(rows, 10, 5, 10, 30, 90)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 200


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    table = spark.createDataFrame([
        (0, [1.0, 0.5], 1, "x", 1), (100, [0.5, 1.0], 1, "x", 1), (1, [0.5, 0.25], 1, "x", 1), (2, [0.4, 0.4], 2, "x", 1), (3, [0.4, 0.4], 2, "x", 1),
        (4, [nan, 1.0], 2, "x", 1), (5, [inf, 1.0], 2, "x", 1), (6, [None, 1.0], 2, "x", 1), (8, None, 2, "x", 1), (9, [0.4, 0.4], None, "x", 1),
        (None, [0.4, 0.4], 2, "x", 1), (3, [0.4, 0.4], 2, "x", 1), (10, [], 1, None, None), (11, [0.5], 3, None, None), (7, [0.3, 0.3], 9, "x", 1),
        (200, [-1.0, 0.0], 5, "x", 1), (201, [1.0, 0.0], 5, "x", 1), (300, [0.0, 0.0], 6, "x", 1), (302, [0.0, 1.0], 6, "x", 1)], SCHEMA)
    rows = [(0, 2, [256, 128]), (100, 1, [128, 256]), (1, 1, [128, 64]), (2, 2, [102, 102]), (3, 2, [102, 102]), (10, 1, []), (11, 3, [128]),
            (7, 0, [76, 76]), (200, 5, [-256, 0]), (201, 5, [256, 0]), (300, 6, [0, 0]), (302, 6, [0, 256])]
    got = H.mine(adjusted(table))
    want = plain(rows, 100, 5, 10, 30, 90)
    assert sorted(tuple(r) for r in got.collect()) == want and {r[0] for r in want} >= {0, 100, 300} and 200 not in {r[0] for r in want}


def test_empty_tables_and_no_anchors(spark):
    assert H.mine(vectors(spark, [])).count() == 0
    assert H.mine(vectors(spark, [(1, 1, [1]), (2, 2, [1])])).count() == 0
    assert H.mine(vectors(spark, [(100, 1, [1]), (2, 2, [1])])).count() == 0
    assert H.mine(vectors(spark, [(100, 1, []), (2, 1, []), (3, 2, [])])).collect() == [(100, 2, 1, 3, 0, 0)]


def test_scores_that_may_not_fit_are_refused(spark):
    with pytest.raises(ValueError, match="may not fit"):
        H.mine(vectors(spark, [(100, 1, [1 << 30]), (2, 2, [1])]))
