import math
import random

import pytest

from tallyframe.operators import matching as X
from tallyframe.operators import recommend as R

SCHEMA = "id int, features array<double>"


def by_hand(asked, others, k):
    """Every pair scored, the terms in order."""

    def usable(v):
        return v is not None and None not in v and all(map(math.isfinite, v))

    rows = []
    for i, a in asked:
        scored = []
        if i is not None and usable(a):
            for j, b in others:
                if j is not None and usable(b):
                    total = 0.0
                    for x, y in zip(a, b):
                        total += x * y
                    scored.append((-total, j))
        rows += [(i, place, j, -s) for place, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows)


def vectors(n, seed, spread):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) * spread ** rng.random() for _ in range(3)]) for i in range(n)]


ODD = [(900, None), (901, [1.0, None, 0.0]), (902, [float("nan"), 1.0, 1.0]), (903, [float("inf"), 1.0, 1.0]), (None, [9.0, 9.0, 9.0]), (904, [0.0, 0.0, 0.0])]


@pytest.mark.parametrize(
    "asked, others",
    [
        (vectors(60, 1, 1), vectors(150, 2, 1)),  # lengths alike: the bound ends nothing
        (vectors(60, 3, 1), vectors(150, 4, 1000)),  # few long rows: most searches end in the first block
        (ODD + vectors(20, 5, 1), ODD + vectors(30, 6, 10)),
        (vectors(20, 7, 1), [(i, [1.0, float(i % 2), 0.0]) for i in range(60)]),  # ties over several blocks
        (vectors(5, 8, 1), vectors(3, 9, 1)),  # fewer than k
        (vectors(5, 8, 1), []),
        ([], vectors(5, 8, 1)),
    ],
)
def test_like_brute_force(spark, asked, others):
    found = X.top_products(spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(others, SCHEMA), k=5, block_rows=7)
    assert found.columns == ["id", "rank", "found", "score"]
    assert sorted(map(tuple, found.collect())) == by_hand(asked, others, 5)


def test_most_pairs_are_left_out(spark, monkeypatch):
    """Where few rows are long, later rounds have no asked rows."""
    others = [(i, [100.0 if i < 7 else 0.01, 1e-3 * i, 0.0]) for i in range(700)]
    asked = [(i, [1.0 + i, 0.0, 0.0]) for i in range(40)]
    rounds, pack = [], X.staged
    monkeypatch.setattr(X, "staged", lambda df, name: (rounds.append(name), pack(df, name))[1])
    found = X.top_products(spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(others, SCHEMA), k=5, block_rows=7)
    assert sorted(map(tuple, found.collect())) == by_hand(asked, others, 5)
    assert rounds.count("best") == 1  # 100 blocks, one of them was met


def test_agrees_with_the_model(spark):
    rng = random.Random(3)
    rows = [(u, i, float(rng.randint(1, 5))) for u in range(30) for i in rng.sample(range(40), 12)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating float")
    model = R.train_factors(ratings, rank=3, iterations=3, blocks=2)
    users, items = spark.createDataFrame([(1,), (2,)], "user int"), spark.createDataFrame([(3,)], "item int")
    for mine, theirs, key in (
        (R.best_items(users, model.userFactors, model.itemFactors), R.items_for_users(model, users), "user"),
        (R.best_users(items, model.userFactors, model.itemFactors), R.users_for_items(model, items), "item"),
    ):
        a = {(r[key], r["rank"]): r["score"] for r in mine.collect()}
        b = {(r[key], r["rank"]): r["score"] for r in theirs.collect()}
        assert a == pytest.approx(b, abs=1e-4)
