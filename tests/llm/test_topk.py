"""Exact top-k products against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import topk
from tallyframe.llm.queries import QUERIES, table

SMALL = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, place int, name string, score long"


def plain(rows, k=5, every=50):
    sound = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in sound:
        if i % every == 0:
            products = [(min(max(sum(a * b for a, b in zip(q, v)), -(1 << 63)), (1 << 63) - 1), j) for j, v in sound if j != i]
            scored = sorted((-s, j) for s, j in products)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def found(spark, rows, monkeypatch=None, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(topk, name, value)
    frame = spark.createDataFrame([(i, v, 1, 2, "n", 3) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.products_query(frame).collect())


def random_rows(n, seed=1, width=6, scale=1.0):
    values = np.random.default_rng(seed).normal(0, scale, (n, width)).astype(np.float32)
    return [(i, [float(x) for x in v]) for i, v in enumerate(values)]


def test_query_against_all_products(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "embeddings").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_top_products"](spark, SMALL).collect()) == plain(rows)


def test_several_blocks_with_ties(spark, monkeypatch):
    rows = random_rows(700, width=3, scale=0.01) + [(700 + i, [0.5, -0.25, 0.0]) for i in range(60)]
    assert found(spark, rows, monkeypatch, BLOCK_VALUES=120, QUERY_VALUES=9) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (50, [0.0, 0.0]), (100, []), (150, [1.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]), (None, [9.0, 9.0]), (5, [1.0, 2.0, 3.0]), (6, [-1.0, 2.0]), (0, [1.0, 2.0]), (7, [1.0, 2.0]),
    ]
    assert found(spark, rows) == plain(rows)


def test_values_beyond_exact_doubles(spark):
    rows = [(i, [float(np.float32(x * 1e30)) for x in v]) for i, v in random_rows(60, seed=3)] + random_rows(60, seed=4, scale=1e6)[1:]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_small_tables(spark, n):
    rows = random_rows(n)
    assert found(spark, rows) == plain(rows)


def test_long_vectors(spark):
    rows = random_rows(4, width=300_000)
    assert found(spark, rows) == plain(rows)


def test_stops_before_all_rows_are_scored():
    """One dimension decides: the lists end after the first step."""
    values = np.zeros((5000, 2))
    values[:, 0] = np.arange(5000)
    orders = np.argsort(values, axis=0, kind="stable").T

    class Counting(np.ndarray):
        scored = 0

        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                Counting.scored += len(key)
            return super().__getitem__(key)

    best = topk.top_of_block(np.array([2.0, 0.0]), -1, np.arange(5000), values.view(Counting), orders, 3)
    assert best == [(9998, 4999), (9996, 4998), (9994, 4997)]
    assert Counting.scored < 100
