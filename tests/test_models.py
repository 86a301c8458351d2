import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
from pyspark.mllib.regression import LabeledPoint
from pyspark.sql import functions as F

from tallyframe.functions.columns import PAGE_KINDS
from tallyframe.operators import evaluate as E
from tallyframe.operators import features as V
from tallyframe.operators import gradient as G
from tallyframe.operators import models as M
from tallyframe.plans.learning import hourly, two_parts
from tallyframe.plans.tables import HOUR_FEATURES

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    """Two classes that a line separates but for some noise, plus a category that helps."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        a, b, c = (rng.gauss(0, 1) for _ in range(3))
        y = float(a - 0.5 * b + rng.gauss(0, 0.4) > 0)
        rows.append((i, "x" if y == (rng.random() < 0.8) else "y", a, b, c, y))
    return spark.createDataFrame(rows, "id int, cat string, a double, b double, c double, label double").persist()


def descent(rows, slope, iterations, step, reg):
    x, y = np.array([r[:3] for r in rows]), np.array([r[3] for r in rows])
    w = np.zeros(3)
    for t in range(1, iterations + 1):
        gradient = (slope(x @ w, y)[:, None] * x).mean(axis=0)
        rate = step / math.sqrt(t)
        w = w * (1 - rate * reg) - rate * gradient
    return w


def test_logistic_steps(spark, points):
    rows = [tuple(r) for r in points.select(*NAMES, "label").collect()]
    model = G.logistic_sgd(points, NAMES, 6, 4.0, fraction=1.0, tolerance=0.0)
    assert model.weights == pytest.approx(descent(rows, lambda m, y: 1 / (1 + np.exp(-m)) - y, 6, 4.0, 0.01))
    rdd = points.select("label", *NAMES).rdd.map(lambda r: LabeledPoint(r[0], list(r[1:])))
    other = LogisticRegressionWithSGD.train(rdd, 6, 4.0, 1.0, convergenceTol=0.0)
    assert model.weights == pytest.approx(list(other.weights), abs=1e-8)


def test_hinge_steps(spark, points):
    def slope(m, y):
        side = 2 * y - 1
        return np.where(side * m < 1, -side, 0.0)

    rows = [tuple(r) for r in points.select(*NAMES, "label").collect()]
    model = G.svm_sgd(points, NAMES, 5, 3.0, 0.1, tolerance=0.0)
    assert model.weights == pytest.approx(descent(rows, slope, 5, 3.0, 0.1))
    rdd = points.select("label", *NAMES).rdd.map(lambda r: LabeledPoint(r[0], list(r[1:])))
    other = SVMWithSGD.train(rdd, 5, 3.0, 0.1, 1.0, convergenceTol=0.0)
    assert model.weights == pytest.approx(list(other.weights), abs=1e-8)


def test_early_stop_matches(spark, points):
    model = G.logistic_sgd(points, NAMES, 100, 10.0, fraction=1.0)
    rdd = points.select("label", *NAMES).rdd.map(lambda r: LabeledPoint(r[0], list(r[1:])))
    other = LogisticRegressionWithSGD.train(rdd, 100, 10.0, 1.0)
    assert model.steps < 100
    assert model.weights == pytest.approx(list(other.weights), abs=1e-8)


def test_mini_batches_learn_and_repeat(points):
    one = G.logistic_sgd(points, NAMES, fraction=0.5)
    assert one == G.logistic_sgd(points, NAMES, fraction=0.5)
    assert E.auc_of_classes(one.transform(points)).first()[0] > 0.85


def test_mini_batches_do_not_depend_on_partitions(points):
    one = G.logistic_sgd(points.repartition(7), NAMES, fraction=0.5, key=["id"])
    other = G.logistic_sgd(points.coalesce(1), NAMES, fraction=0.5, key=["id"])
    assert one.weights == pytest.approx(other.weights, abs=1e-9)
    assert one.weights != pytest.approx(G.logistic_sgd(points, NAMES, fraction=0.8, key=["id"]).weights, abs=1e-3)


def test_lockstep_gives_what_each_setting_gives_alone(points):
    settings = [G.Descent(n, step, fraction=f) for n in (1, 4, 40) for step in (0.5, 10.0) for f in (0.5, 1.0)]
    together = G.descend_all(points, NAMES, G.logistic_slope, settings, key=["id"])
    for setting, model in zip(settings, together):
        alone = G.descend_all(points, NAMES, G.logistic_slope, [setting], key=["id"])[0]
        assert model.steps == alone.steps
        assert model.weights == pytest.approx(alone.weights, abs=1e-9)
    rates = {r.trial: r.metric for r in G.auc_of_models(together, points).collect()}
    for i, model in enumerate(together):
        assert rates[i] == pytest.approx(E.auc_of_classes(model.transform(points)).first()[0])


def test_descent_without_rows(points):
    model = G.logistic_sgd(points.filter("false"), NAMES)
    assert model.weights == (0.0, 0.0, 0.0) and model.steps == 0


ESTIMATORS = {
    "tree": lambda: M.tree_classifier("gini", 10, 14),
    "entropy": lambda: M.tree_classifier("entropy", 5, 5),
    "forest": lambda: M.forest_classifier(10),
    "logistic": lambda: M.logistic_classifier("features"),
    "svm": lambda: M.svm_classifier("features"),
}


@pytest.mark.parametrize("name", ESTIMATORS)
def test_classifiers_beat_chance(points, name):
    train, test = two_parts(points, "id")
    model = M.fit(V.category_stages("cat", NAMES), ESTIMATORS[name](), train)
    scored = model.transform(test)
    assert scored.count() == test.count() > 0
    assert E.binary_evaluator().evaluate(scored) > 0.85
    assert {r[0] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}
    if "probability" in scored.columns:
        total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda s, p: s + p)
        assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    texts = M.describe(scored, PAGE_KINDS).select("description").distinct().collect()
    assert {r[0] for r in texts} <= set(PAGE_KINDS.values())


def test_bayes_needs_nonnegative_input(points):
    with pytest.raises(Exception, match="(?i)negative"):
        M.fit(V.numeric_stages(NAMES, "scaled"), M.bayes_classifier(), points)


def test_rules_and_importances(points):
    tree = M.fit(V.numeric_stages(NAMES), M.tree_classifier(depth=3), points).stages[-1]
    assert "If (feature" in M.rules(tree)
    rows = M.importances(tree, NAMES, points).collect()
    assert rows[0].feature == "a" and sum(r.importance for r in rows) == pytest.approx(1)


def test_regressors_beat_the_mean(spark):
    rng = random.Random(4)
    rows = [(i % 24, rng.random(), 0.0) for i in range(600)]
    rows = [(h, t, 10.0 * abs(h - 12) + 20 * t + rng.gauss(0, 2)) for h, t, _ in rows]
    df = spark.createDataFrame(rows, "hr int, temp double, cnt double")
    spread = df.agg(F.stddev("cnt")).first()[0]
    for stages, estimator in (
        (V.indexed_stages(["hr", "temp"]), M.tree_regressor()),
        (V.numeric_stages(["hr", "temp"]), M.tree_regressor(maxDepth=10, maxBins=100)),
        (V.indexed_stages(["hr", "temp"]), M.boosted_regressor(maxIter=5, maxBins=25)),
    ):
        error = E.rmse(M.fit(stages, estimator, df).transform(df), label="cnt").first()[0]
        assert error < spread / 2


def brute_root(rows):
    """Best split of one category column by variance: categories ordered by mean label."""
    groups = {}
    for h, y in rows:
        groups.setdefault(h, []).append(y)
    order = sorted(groups, key=lambda h: (np.mean(groups[h]), h))

    def loss(part):
        values = [y for h in part for y in groups[h]]
        return np.var(values) * len(values)

    cut = min(range(1, len(order)), key=lambda i: loss(order[:i]) + loss(order[i:]))
    return {h: np.mean([y for k in part for y in groups[k]]) for part in (order[:cut], order[cut:]) for h in part}


def test_root_split_is_the_best_one(tables):
    hours = hourly(tables)
    model = M.fit(V.indexed_stages(["hr"]), M.tree_regressor(maxDepth=1), hours)
    wanted = brute_root([tuple(r) for r in hours.select("hr", "cnt").collect()])
    for hr, prediction in model.transform(hours).select("hr", "prediction").distinct().collect():
        assert prediction == pytest.approx(wanted[hr])


def test_fit_leaves_a_callers_cache_alone(points):
    M.fit(V.numeric_stages(NAMES), M.tree_classifier(depth=2), points)
    assert points.storageLevel.useMemory
    other = points.select(*NAMES, "label").filter("a > -9")
    M.fit(V.numeric_stages(NAMES), M.tree_classifier(depth=2), other)
    assert not other.storageLevel.useMemory


def test_hour_columns(tables):
    assert [c for c in hourly(tables).columns if c != "instant"] == [*HOUR_FEATURES, "cnt"]
