"""Forests that differ in depth alone are trained once, and give what each trained by itself gives."""

import random

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import TrainValidationSplit

from tallyframe.operators import evaluate as E
from tallyframe.operators import models as M
from tallyframe.operators import trees as N
from tallyframe.operators import tuning as U


def frame(spark):
    rng = random.Random(8)
    data = [(rng.random(), float(rng.randrange(9)), rng.random(), float(i % 4), float(rng.random() < 0.4)) for i in range(600)]
    rows = spark.createDataFrame(data, "a double, b double, c double, d double, label double").coalesce(2)
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(rows)


def test_forest_search_trains_the_deepest(spark, monkeypatch):
    rows, fits, fit = frame(spark), [], RandomForestClassifier._fit
    grid = {"impurity": ["gini", "entropy"], "maxDepth": [2, 5, 9], "maxBins": [6], "numTrees": [3, 6]}
    forest, evaluator = M.forest_classifier(), E.binary_evaluator()
    alone = TrainValidationSplit(
        estimator=forest, estimatorParamMaps=U.param_maps(forest, grid), evaluator=evaluator, trainRatio=0.8, seed=17, parallelism=1
    ).fit(rows)
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: (fits.append(self.getMaxDepth()), fit(self, df))[1])
    trials = U.train_validation([], forest, grid, evaluator, rows)[1].orderBy("trial").collect()
    assert fits[:-1] == [9] * 4  # the last is the best setting on all rows
    assert [r.metric for r in trials] == alone.validationMetrics


def test_cut_forest_has_the_raw_predictions(spark):
    rows = frame(spark)
    deep = M.forest_classifier(5, maxDepth=8).fit(rows)
    found = N.forest_scores(deep, rows, [1, 4, 8]).select("raw0", "raw1", "raw2").collect()
    for i, depth in enumerate([1, 4, 8]):
        model = M.forest_classifier(5, maxDepth=depth).fit(rows)
        assert [r[i] for r in found] == [r.rawPrediction[1] for r in model.transform(rows).select("rawPrediction").collect()]


def test_levels_beyond_one_step_are_trained_alone(spark):
    forest = M.forest_classifier(30)
    assert N.same_when_cut(forest, 30, 20, 10, 10) and not N.same_when_cut(forest, 30, 20, 14, 10)
    rows = frame(spark)
    maps = U.param_maps(forest, {"maxDepth": [14, 15], "numTrees": [30], "maxBins": [200]})
    assert U._forest_groups(forest, maps, E.binary_evaluator(), rows) == [[1], [0]]
    assert U._forest_groups(forest, maps, E.accuracy_evaluator(), rows) is None
