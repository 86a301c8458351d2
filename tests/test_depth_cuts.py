"""Trees that differ in depth alone are trained once, and give what each trained by itself gives."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier

from tallyframe.operators import evaluate as E
from tallyframe.operators import features as V
from tallyframe.operators import models as M
from tallyframe.operators import tuning as U


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [(rng.random(), float(rng.randrange(9)), rng.choice("pqr"), float(rng.randrange(3))) for _ in range(500)]
    return spark.createDataFrame(data, "a double, b double, cat string, label double")


@pytest.fixture
def fits(monkeypatch):
    seen, fit = [], DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, df: (seen.append(self.getMaxDepth()), fit(self, df))[1])
    return seen


def test_search_trains_the_deepest(rows, fits):
    grid = {"impurity": ["gini", "entropy"], "maxDepth": [1, 3, 6], "maxBins": [8]}
    args = V.category_stages("cat", ["a", "b"]), M.tree_classifier(), grid, E.accuracy_evaluator(), rows
    trials = U.train_validation(*args)[1].orderBy("trial").collect()
    assert fits[:-1] == [6, 6]  # the last is the best setting on all rows
    split = V.category_stages("cat", ["a", "b"])
    from pyspark.ml import Pipeline
    from pyspark.sql import functions as F

    drawn = Pipeline(stages=split).fit(rows).transform(rows).withColumn("_draw", F.rand(17)).persist()
    for r, setting in zip(trials, U.full_grid(grid)):
        model = M.tree_classifier(setting["impurity"], setting["maxDepth"], setting["maxBins"]).fit(drawn.filter("_draw < 0.8"))
        assert r.metric == pytest.approx(E.accuracy_evaluator().evaluate(model.transform(drawn.filter("_draw >= 0.8"))))


def test_sweep_trains_the_deepest(rows, fits):
    train, held = rows.filter("a < 0.7"), rows.filter("a >= 0.7")
    settings = U.full_grid({"depth": [2, 7, 4], "bins": [6, 12]})

    def one(df, depth, bins):
        return M.fit(V.category_stages("cat", ["b"]), M.tree_classifier("gini", depth, bins), df)

    done = U.sweep(train, held, settings, one, E.accuracy, depth="depth")
    assert fits == [7, 7]
    for r, model, s in zip(done.trials.orderBy("trial").collect(), done.models, settings):
        alone = one(train, **s).transform(held)
        assert r.metric == pytest.approx(E.accuracy(alone).first()[0])
        assert [x.prediction for x in model.transform(held).collect()] == [x.prediction for x in alone.collect()]
