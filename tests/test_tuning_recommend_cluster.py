import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from tallyframe.operators import cluster as K
from tallyframe.operators import evaluate as E
from tallyframe.operators import features as V
from tallyframe.operators import gradient as G
from tallyframe.operators import models as M
from tallyframe.operators import recommend as R
from tallyframe.operators import tuning as U
from tallyframe.sources.sinks import save_model_once


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(300)]
    rows = [(i, a, b, float(a + b > 0), i % 3) for i, a, b in rows]
    return spark.createDataFrame(rows, "id int, a double, b double, label double, fold int")


def test_grid_sizes():
    sizes = [len(U.full_grid(g)) for g in (U.TREE_GRID, U.FOREST_GRID, U.MULTICLASS_GRID, U.REGRESSION_GRID, U.BOOSTED_GRID)]
    assert sizes == [18, 54, 18, 16, 8]
    assert [len(U.full_grid(g)) for g in (U.TREE_SWEEP, U.LOGISTIC_SWEEP, U.SVM_SWEEP, U.BAYES_SWEEP)] == [72, 84, 84, 13]
    assert U.vary({"x": 1, "y": 2}, "y", [3, 4]) == [{"x": 1, "y": 3}, {"x": 1, "y": 4}]
    each = U.vary_each({"x": 1, "y": 2}, {"x": [1, 5], "y": [2, 3]})
    assert each == [{"x": 1, "y": 2}, {"x": 5, "y": 2}, {"x": 1, "y": 3}]
    varied = [U.vary_each(U.TREE_AROUND, U.TREE_SWEEP), U.vary_each(U.LOGISTIC_AROUND, U.LOGISTIC_SWEEP), U.vary_each(U.SVM_AROUND, U.SVM_SWEEP)]
    assert [len(v) for v in varied] == [12, 12, 12]


def test_tuners_return_the_best_of_their_trials(points):
    grid = {"maxDepth": [1, 4], "impurity": ["gini", "entropy"]}
    stages, tree = V.numeric_stages(["a", "b"]), M.tree_classifier()
    for model, trials in (
        U.train_validation(stages, tree, grid, E.binary_evaluator(), points),
        U.cross_validation(stages, tree, grid, E.binary_evaluator(), points, fold_column="fold"),
    ):
        best = U.best_trial(trials).first()
        assert trials.count() == 4
        assert f"maxDepth={model.stages[-1].bestModel.getOrDefault('maxDepth')}" in best.params


def test_sweep_and_first_of_equals(points):
    def train_one(rows, **setting):
        return G.logistic_sgd(rows, ["a", "b"], fraction=1.0, **setting)

    settings = U.full_grid({"iterations": [1, 3], "step": [1.0, 10.0]})
    done = U.sweep(points, points, settings, train_one, E.auc_of_classes)
    trials = sorted(done.trials.collect())
    assert [t.params for t in trials] == [f"iterations={i}, step={s}" for i in (1, 3) for s in (1.0, 10.0)]
    assert all(t.seconds > 0 for t in trials)
    best = max(trials, key=lambda t: (t.metric, -t.trial))
    assert done.best() is done.models[best.trial]
    assert not points.storageLevel.useMemory


def test_best_trial_direction_ties_and_nulls(spark):
    trials = spark.createDataFrame([(0, None), (1, 0.5), (2, 0.9), (3, 0.9), (4, 0.5)], "trial int, metric double")
    assert U.best_trial(trials).first().trial == 2
    assert U.best_trial(trials, larger_is_better=False).first().trial == 1


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(6)
    taste = [[rng.random() for _ in range(2)] for _ in range(70)]
    rows = [
        (u, i, float(1 + 2 * (taste[u][0] * taste[40 + i][0] + taste[u][1] * taste[40 + i][1])))
        for u in range(40) for i in range(30) if rng.random() < 0.7
    ]
    return spark.createDataFrame(rows, "user int, item int, rating float")


def test_recommendations(spark, ratings, tmp_path):
    model = R.train_factors(ratings, blocks=2)
    titles = spark.createDataFrame([(i, f"title {i}") for i in range(30)], "item int, title string")
    users = spark.createDataFrame([(3,), (5,)], "user int")
    rows = sorted(R.items_for_users(model, users, titles).collect(), key=lambda r: (r.user, r.rank))
    assert [(r.user, r.rank) for r in rows] == [(u, k) for u in (3, 5) for k in range(1, 11)]
    assert all(r.title == f"title {r.item}" for r in rows)
    user = {r.id: r.features for r in model.userFactors.collect()}
    item = {r.id: r.features for r in model.itemFactors.collect()}
    for u in (3, 5):
        scores = {i: sum(a * b for a, b in zip(user[u], f)) for i, f in item.items()}
        best = sorted(scores.values(), reverse=True)[:10]
        assert [r.score for r in rows if r.user == u] == pytest.approx(best, abs=1e-4)
    found = R.users_for_items(model, spark.createDataFrame([(7,)], "item int")).collect()
    assert len({r.user for r in found}) == 10
    scores = [r.score for r in sorted(found, key=lambda r: r.rank)]
    assert scores == sorted(scores, reverse=True)
    path = str(tmp_path / "factors")
    assert save_model_once(model, path)
    assert not save_model_once(model, path)
    again = R.items_for_users(R.load_model(path), users, titles)
    assert sorted(again.collect()) == sorted(R.items_for_users(model, users, titles).collect())
    error = E.rmse(model.transform(ratings), label="rating").first()[0]
    assert error < ratings.agg(F.stddev("rating")).first()[0] / 2


def test_factors_by_sums_with_one_hot_item(spark):
    """A third of all ratings is on one item; the same alternating steps in numpy give the same products."""
    rng = random.Random(6)
    pairs = {(u, 0) for u in range(120)} | {(rng.randrange(120), rng.randrange(1, 30)) for _ in range(300)}
    data = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u, i in sorted(pairs)]
    ratings = spark.createDataFrame([*data, (None, 1, 2.0), (3, None, 2.0)], "user int, item int, rating float")
    users, items = R.train_by_sums(ratings, 3, 4, 0.05)
    seeds = ratings.dropna().select("item", *[((F.pmod(F.xxhash64("item", F.lit(k)), F.lit(1000)) + 1) / 1000.0).alias(f"s{k}") for k in range(3)])
    other = {r[0]: np.array(r[1:]) for r in seeds.distinct().collect()}
    mine = {}
    for _ in range(4):
        for at in (0, 1):
            solved = {}
            for key in {d[at] for d in data}:
                met = [(other[d[1 - at]], d[2]) for d in data if d[at] == key]
                x, y = np.array([m[0] for m in met]), np.array([m[1] for m in met])
                solved[key] = np.linalg.solve(x.T @ x + 0.05 * len(y) * np.eye(3), x.T @ y)
            other, mine = solved, other
    found = {r.id: r.features for r in items.collect()}
    assert set(found) == set(other)
    assert all(found[i] == pytest.approx(other[i].tolist(), abs=1e-6) for i in other)
    assert R.off_optimum(ratings, items, users, "item", "user", 3, 0.05).agg(F.max("residual")).first()[0] < 1e-9
    assert R.off_optimum(ratings, users, items, "user", "item", 3, 0.05).agg(F.max("residual")).first()[0] > 1e-9


def test_missing_model_raises(spark, tmp_path):
    with pytest.raises(Exception, match="does not exist"):
        R.load_model(str(tmp_path / "none"))


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(8)
    rows = [(round(rng.gauss(5 * (i % 3), 0.5), 1), round(rng.gauss(-4 * (i % 3), 0.5), 1)) for i in range(900)]
    return spark.createDataFrame(rows, "x double, y double")


def test_weighted_points_cluster_like_all_rows(blobs):
    with K.weighted_points(blobs, [("x", "y")]) as points:
        assert points.frame.agg(F.sum("weight")).first()[0] == 900
        assert points.frame.count() < 900
        found = K.best_kmeans(points, [3], starts=3)[3]
    centers, cost = list(found.centers), found.cost
    assert centers == sorted(centers) and sum(found.sizes) == 900
    plain = V.numeric_stages(["x", "y"])[0].transform(blobs)
    whole = min((KMeans(k=3, seed=s).fit(plain) for s in range(3)), key=lambda m: m.summary.trainingCost)
    assert sum(centers, ()) == pytest.approx(sum(sorted(tuple(c) for c in whole.clusterCenters()), ()), abs=1e-3)
    assert cost == pytest.approx(whole.summary.trainingCost, rel=1e-6)
    assert K.squared_error(blobs, ("x", "y"), centers).first()[0] == pytest.approx(cost, rel=1e-6)


def test_nearest_center_and_ties(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (9.0, 0.0)], "x double, y double")
    got = K.assign(df, ("x", "y"), [(0.0, 0.0), (2.0, 0.0), (10.0, 0.0)]).collect()
    assert [(r.cluster, r.distance2) for r in got] == [(0, 0.0), (0, 1.0), (2, 1.0)]


def test_elbow_falls(blobs):
    rows = K.elbow(blobs, [("x", "y")], starts=4).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4, 5]
    assert all(a.sse >= b.sse for a, b in zip(rows, rows[1:]))
    assert rows[0].sse - rows[1].sse > 5 * (rows[1].sse - rows[2].sse)


def test_report(blobs):
    rows = K.report(blobs, [("x", "y")], 3, starts=2).collect()
    assert sorted(r.counts for r in rows) == [300, 300, 300]
    low, high, mean = blobs.agg(F.min("y"), F.max("y"), F.avg("y")).first()
    wide = max(r[0] for r in blobs.select(F.max("x") - F.min("x")).collect())
    half = max(high - low + 1, wide + 1) / 2
    assert rows[0].y_low == pytest.approx(mean - half) and rows[0].y_high == pytest.approx(mean + half)


def test_pairs():
    assert K.column_pairs("abcd") == [("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d")]
