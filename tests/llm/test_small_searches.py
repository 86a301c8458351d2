"""Nearest neighbours of small tables: all candidates, if there are fewer than asked for."""

import random

import pytest

from tallyframe.llm import ann


@pytest.mark.parametrize("n", [1, 2, 4, 6, 8, 12])
def test_every_candidate_of_a_small_table(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(n)]
    found = ann.nearest_query(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(r.rank for r in found) == list(range(1, min(5, n - 1) + 1))


def test_repeated_rows_of_the_query_are_no_candidates(spark):
    rows = [(50, [1.0, float(i)], 0) for i in range(10)] + [(i, [1.0, i / 10], 0) for i in range(1, 8)]
    found = ann.nearest_query(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert 50 not in {r.vec_id for r in found}
    assert {r.rank for r in found} == {1, 2, 3, 4, 5}
