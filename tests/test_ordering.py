import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import ordering
from tallyframe.operators.ordering import ranges_for, row_position, running_sums


@pytest.mark.parametrize("per_range", [7, 60, 10_000])
def test_positions_match_a_sort(spark, per_range):
    rng = random.Random(3)
    # a third of all rows share one first key
    rows = [(0 if i % 3 == 0 else rng.randint(-50, 50), f"k{i:04d}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, i int").repartition(5)
    placed = row_position(df, ["a", "b"], 500, rows_per_range=per_range)
    assert placed.columns == ["a", "b", "i", "position"]
    got = {r.i: r.position for r in placed.collect()}
    wanted = {r[2]: n for n, r in enumerate(sorted(rows), 1)}
    assert got == wanted


def test_one_hot_first_key_is_cut_by_the_second(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), "id")
    sizes = ordering._ranged(df, ["a", "id"], 15).groupBy("_range").count().collect()
    assert len(sizes) > 10
    assert max(r["count"] for r in sizes) < 500


def test_number_of_ranges():
    assert [ranges_for(n, 10) for n in (0, 1, 10, 11, 10**9)] == [1, 1, 1, 2, 100_000]


def test_positions_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).select("id", (F.col("id") * 7 % 13).alias("v"))
    one = row_position(df.repartition(3), ["v", "id"], 1000, rows_per_range=50).collect()
    two = row_position(df.repartition(11), ["v", "id"], 1000, rows_per_range=90).collect()
    assert sorted(one) == sorted(two)


@pytest.mark.parametrize("per_range", [9, 1000])
def test_running_sums(spark, per_range):
    rng = random.Random(5)
    rows = [(float(i), rng.randint(-9, 9), rng.randint(0, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, p long, q long").repartition(3)
    sums = {"sp": F.col("p"), "sq": F.col("q") * 2}
    got = running_sums(df, ["x"], sums, 200, rows_per_range=per_range)
    assert got.columns == ["x", "p", "q", "sp", "sq"]
    p = q = 0
    for row, (_, a, b) in zip(sorted(got.collect()), rows):
        p, q = p + a, q + 2 * b
        assert (row.sp, row.sq) == (p, q)


def test_empty_and_timestamp_keys(spark):
    assert row_position(spark.createDataFrame([], "a int"), ["a"], 0).count() == 0
    days = spark.range(40).select(F.timestamp_seconds(F.col("id") * 86400).alias("t"), "id")
    assert all(r.position == r.id + 1 for r in row_position(days, ["t"], 40, rows_per_range=7).collect())


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 3), (1, 4), (9, 5), (7, 6)], "a int, b int")
    for per_range in (2, 100):
        got = row_position(df, ["a", "b"], 6, rows_per_range=per_range).orderBy("position").collect()
        assert [r.b for r in got] == [1, 2, 4, 3, 6, 5]


def test_one_shuffle_for_positions(spark):
    df = row_position(spark.range(100), ["id"], 100, rows_per_range=10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # already stored in ranges
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
