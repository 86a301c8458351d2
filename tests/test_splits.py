import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import splits as S


def test_hash_split_is_a_partition_and_ignores_layout(spark):
    df = spark.range(5000)
    parts = {"train": 80, "validation": 10, "test": 10}
    one = S.hash_split(df, ["id"], parts)
    two = S.hash_split(df.repartition(7), ["id"], parts)
    assert sorted(one.collect()) == sorted(two.collect())
    share = {r.part: r["count"] / 5000 for r in one.groupBy("part").count().collect()}
    assert abs(share["train"] - 0.8) < 0.03 and abs(share["test"] - 0.1) < 0.02
    assert sum(share.values()) == pytest.approx(1)


def test_random_split_covers_all_rows(spark):
    parts = S.random_split(spark.range(300), [8, 1, 1], seed=1)
    assert sorted(r.id for p in parts for r in p.collect()) == list(range(300))


@pytest.mark.parametrize("rows", [0, 3, 100, 103])
def test_positional_folds(spark, rows):
    folded = S.positional_folds(spark.range(rows).repartition(3), ["id"], 5, rows_per_range=20)
    size = -(-rows // 5)
    assert sorted((r.id, r.fold) for r in folded.collect()) == [(i, i // size + 1) for i in range(rows)]
    for fold in range(1, 6):
        test = {r.id for r in S.fold_test(folded, fold).collect()}
        base = {r.id for r in S.fold_base(folded, fold).collect()}
        assert not test & base and test | base == set(range(rows))


def brute_leave_out(rows, start, stop, cap):
    seen, taken, held = {}, 0, set()
    for at, user in sorted(rows):
        seen[user] = seen.get(user, 0) + 1
        if (taken < cap or cap <= 0) and start <= seen[user] <= stop:
            taken += 1
            held.add(at)
    return held


@pytest.mark.parametrize(("start", "stop"), [(1, 10), (11, 20), (3, 3)])
@pytest.mark.parametrize("cap", [0, 1, 17, 10_000])
def test_leave_n_out_matches_a_scan_in_order(spark, start, stop, cap):
    rng = random.Random(11)
    # user 0 holds a third of all rows, some users have fewer rows than start
    rows = [(i, 0 if i % 3 == 0 else rng.randint(1, 25)) for i in range(600)]
    df = spark.createDataFrame(rows, "at int, user int").repartition(4)
    marked = S.leave_n_out(df, "user", ["at"], start, stop, cap, rows_per_range=13)
    assert marked.columns == ["at", "user", "held_out"]
    got = marked.collect()
    assert len(got) == 600
    assert {r["at"] for r in got if r.held_out} == brute_leave_out(rows, start, stop, cap)


def test_only_the_first_ranks_cross_the_shuffle(spark, tables):
    events = tables("events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_id")
    marked = S.leave_n_out(events, "user_id", ["at", "event_id"], 1, 10)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 1000])
@pytest.mark.parametrize("parts", [{"a": 80, "b": 20}, {"a": 1, "b": 0, "c": 2, "d": 1}, {"a": 0, "b": 1}])
def test_exact_split_has_exact_sizes(spark, n, parts):
    df = spark.range(n)
    found = {r["id"]: r["part"] for r in S.exact_split(df, ["id"], parts).collect()}
    order = sorted(range(n), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()[:15])
    bound, wanted, total = 0, {}, sum(parts.values())
    for part, weight in parts.items():
        for i in order[n * bound // total : n * (bound + weight) // total]:
            wanted[i] = part
        bound += weight
    assert found == wanted


def test_exact_split_keeps_equal_keys_together(spark):
    rows = [(i % 3, i) for i in range(90)]
    found = S.exact_split(spark.createDataFrame(rows, "k int, i int"), ["k"], {"a": 50, "b": 50})
    assert found.groupBy("k").agg(F.count_distinct("part").alias("parts")).filter("parts > 1").count() == 0
