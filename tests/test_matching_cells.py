"""Asked rows of near direction meet only the rows that can be among their best, whatever the lengths."""

import math
import random

import numpy as np
import pytest

from tallyframe.operators import matching as X

SCHEMA = "id int, features array<double>"


def turned(n, seed, length=lambda rng: 1.0):
    rng = random.Random(seed)
    return [(i, [round(math.cos(a := rng.uniform(-1.2, 1.2)) * (s := length(rng)), 6), round(math.sin(a) * s, 6)]) for i in range(n)]


def best(asked, others, k):
    """Every pair scored."""
    out = []
    for i, (a, b) in asked:
        hits = sorted((-(a * x + b * y), j) for j, (x, y) in others)[:k]
        out += [(i, place, j, -s) for place, (s, j) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("length", [lambda rng: 1.0, lambda rng: 10 ** rng.uniform(-2, 2)])
def test_no_round_where_cells_are_narrow(spark, monkeypatch, length):
    names, write = [], X.staged
    monkeypatch.setattr(X, "PACK_ROWS", 6)
    monkeypatch.setattr(X, "AT_ONCE", 50)
    monkeypatch.setattr(X, "staged", lambda df, name: (names.append(name), write(df, name))[1])
    asked, others = turned(400, 1, length), turned(900, 2, length)
    found = X.top_products(spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(others, SCHEMA), k=3, block_rows=200)
    assert sorted(map(tuple, found.collect())) == best(asked, others, 3)
    assert names == ["asked", "best"]  # all lengths alike took every block before


def test_cells_and_rounds_together(spark, monkeypatch):
    monkeypatch.setattr(X, "PACK_ROWS", 6)
    asked = turned(60, 3) + [(100, [0.0, 0.0]), (101, [1e-120, 1e-120]), (102, [-1.0, 0.2])]
    others = turned(150, 4) + [(i, [1.0, 0.0]) for i in range(200, 240)]  # ties, more than a cell may have
    found = X.top_products(spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(others, SCHEMA), k=4, block_rows=20)
    assert sorted(map(tuple, found.collect())) == best(asked, others, 4)


@pytest.mark.parametrize("spread", [0.0, 0.05, 0.4, 5.0])
def test_bounds_hold(spread):
    rng = np.random.default_rng(5)
    units = np.array([1.0, -2.0, 0.5]) + rng.normal(size=(40, 3)) * spread
    units /= np.linalg.norm(units, axis=1)[:, None]
    rows = rng.normal(size=(200, 3)) * 10.0 ** rng.integers(-3, 4, (200, 1))
    rows = np.concatenate([rows, units * 3, -units, np.zeros((1, 3))])
    low, high = X._Cones.of([{"cell": 0, "low": units.min(axis=0).tolist(), "high": units.max(axis=0).tolist()}]).bounds(rows)
    products = rows @ units.T
    assert (low <= products).all() and (products <= high).all()
