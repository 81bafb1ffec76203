import random

import pytest
from pyspark.sql import functions as F

from duolect.operators import resume, shards


def test_positions_are_dense_in_order(spark):
    rng = random.Random(3)
    orders = rng.sample(range(2**44), 300) + list(range(2**33, 2**33 + 9000))
    rows = [(o, s) for s in "ab" for o in orders]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "row_no bigint, seg string").repartition(7)
    whole = {(r.seg, r.row_no): r.idx for r in shards.with_row_index(df, segment=["seg"]).collect()}
    assert [whole[k] for k in sorted(whole)] == list(range(len(rows)))
    within = shards.with_row_index(df, segment=["seg"], restart=True).collect()
    assert {(r.seg, r.row_no): r.idx for r in within} == {
        (s, o): i for s in "ab" for i, o in enumerate(sorted(orders))}
    empty = shards.with_row_index(df.where("row_no < 0"))
    assert empty.count() == 0 and empty.columns == ["row_no", "seg", "idx"]


def test_sparse_positions_of_a_million_rows(spark):
    """A bucket for nearly every row, negative orders and the ends of the range among them."""
    spread = (F.col("id") * F.lit(9_223_372_036_854) + F.pmod(F.hash("id"), F.lit(1000)) - F.lit(2**62)).alias("row_no")
    ends = spark.createDataFrame([(-2**63, -1), (2**63 - 1, 1_000_000)], "row_no bigint, want bigint")
    df = spark.range(1_000_000).select(spread, F.col("id").alias("want")).union(ends)
    placed = shards.with_row_index(df)
    assert placed.where("idx <> want + 1").count() == 0 and placed.agg(F.max("idx")).first()[0] == 1_000_001


def test_positions_have_no_window_without_a_partition(spark):
    """A window's specification in the optimised plan lists its partition columns before the first order."""
    df = spark.range(9).withColumnRenamed("id", "row_no")
    plan = shards.with_row_index(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 4 and all(line.count("], [") == 2 for line in windows), windows


@pytest.mark.parametrize("count", [0, 1, 3, 7])
def test_shards_split_rows_like_a_strided_slice(spark, count):
    df = spark.range(50).select(F.col("id").alias("row_no"))
    dealt = shards.assign_shards(shards.with_row_index(df), count).collect()
    everything = list(range(50))
    for shard in range(max(count, 1)):
        mine = sorted(r.row_no for r in dealt if r.shard == shard)
        assert mine == (everything[shard::count] if count > 1 else everything)


def test_limits_keep_the_head_of_each_shard(spark):
    df = shards.assign_shards(shards.with_row_index(spark.range(50).withColumnRenamed("id", "row_no")), 4)
    kept = shards.limit_per_shard(df, 4, 5).collect()
    for shard in range(4):
        assert sorted(r.row_no for r in kept if r.shard == shard) == list(range(50))[shard::4][:5]
    assert shards.limit_per_shard(df, 4, 0).count() == 50
    with pytest.raises(ValueError):
        shards.take_shard(df, 4, 4)


def test_shuffle_repeats_for_a_seed_and_differs_between_seeds(spark):
    df = spark.range(500).select(F.col("id").alias("row_no"), F.lit("same").alias("id"))
    order = lambda seed: [r.row_no for r in shards.seeded_shuffle(df, seed).orderBy("idx").collect()]
    first = order(1)
    assert first == order(1) and first != order(2) and sorted(first) == list(range(500))
    assert first != list(range(500))


def test_first_success_wins_like_a_sequential_loop(spark):
    """Random outcomes, with one key holding a third of all rows."""
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.33 else f"k{rng.randint(0, 60)}", rng.random() < 0.5)
            for i in range(600)]
    df = spark.createDataFrame(rows, "idx bigint, sample_id string, fine boolean").select(
        "idx", "sample_id", F.lit("ruen").alias("direction"),
        F.when(F.col("fine"), "ok").otherwise("error").alias("status"),
        F.when(~F.col("fine"), "ValueError").alias("error_kind"))
    done, want = set(), {}
    for i, key, fine in rows:
        want[i] = "skipped" if key in done else "ok" if fine else "error"
        if fine:
            done.add(key)
    got = resume.first_success_wins(df).collect()
    assert {r.idx: r.status for r in got} == want
    assert all((r.error_kind is not None) == (r.status == "error") for r in got)

    ranks, seen = {}, {}
    for i, key, _ in rows:
        ranks[i] = seen.setdefault(key, 0)
        seen[key] += 1
    assert {r.idx: r["rank"] for r in resume.rank_within_key(df).collect()} == ranks


def test_done_rows_are_dropped_or_flagged(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "sample_id string")
    done = spark.createDataFrame([("a",), ("a",), ("z",)], "sample_id string")
    assert sorted(r[0] for r in resume.drop_done(df, done).collect()) == ["b", "c"]
    flagged = sorted((r.sample_id, r.done) for r in resume.flag_done(df, done).collect())
    assert flagged == [("a", True), ("a", True), ("b", False), ("c", False)]
