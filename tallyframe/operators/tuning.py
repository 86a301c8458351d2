"""Hyper-parameter search: grids over one split or folds, and trial tables.

Fits run on the cluster one after the other or ``parallelism`` at a time; the driver holds
one row per trial.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import product
from multiprocessing.pool import ThreadPool
from time import monotonic
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder, TrainValidationSplitModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.holding import held
from tallyframe.operators.trees import CutTree, forest_scores, same_when_cut

# The full grids, by tuner and by model.
TREE_GRID = {"impurity": ["gini", "entropy"], "maxDepth": [5, 10, 15], "maxBins": [10, 15, 20]}
FOREST_GRID = {**TREE_GRID, "numTrees": [10, 20, 30]}
MULTICLASS_GRID = {"impurity": ["gini", "entropy"], "maxDepth": [10, 15, 25], "maxBins": [30, 40, 50]}
REGRESSION_GRID = {"maxDepth": [5, 10, 15, 25], "maxBins": [25, 35, 45, 50]}
BOOSTED_GRID = {"maxDepth": [5, 10], "maxBins": [25, 40], "maxIter": [10, 50]}
TREE_SWEEP = {
    "impurity": ["gini", "entropy"],
    "depth": [3, 5, 10, 15, 20, 25],
    "bins": [3, 5, 10, 50, 100, 200],
}
LOGISTIC_SWEEP = {
    "iterations": [3, 5, 10, 15, 20, 60, 100],
    "step": [10, 50, 100, 200],
    "fraction": [0.5, 0.8, 1.0],
}
SVM_SWEEP = {"iterations": [1, 3, 5, 10, 15, 20, 25], "step": [10, 50, 100, 200], "reg": [0.01, 0.1, 1.0]}
# The settings around which one parameter at a time varies.
TREE_AROUND = {"impurity": "gini", "depth": 10, "bins": 10}
LOGISTIC_AROUND = {"iterations": 15, "step": 10, "fraction": 1.0}
SVM_AROUND = {"iterations": 25, "step": 100, "reg": 1.0}
BAYES_SWEEP = {"smoothing": [1.0, 3.0, 5.0, 10.0, 15.0, 20.0, 25.0, 30.0, 35.0, 40.0, 45.0, 50.0, 60.0]}


def param_maps(estimator, grid: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def in_threads(spark: SparkSession, jobs: Sequence[Callable[[], Any]], parallelism: int) -> list:
    """The results of ``jobs``, ``parallelism`` at a time.

    Every job is wrapped by itself and so has local properties of its own. Spark's tuners, and one wrapper for all jobs, share
    one set among the threads: a query that ends in one then clears the execution id that another is about to read.
    """
    targets = [inheritable_thread_target(spark)(job) for job in jobs]
    with ThreadPool(max(1, min(parallelism, len(targets)))) as pool:
        return pool.map(lambda target: target(), targets, chunksize=1)


def _by_depth(settings: Sequence[Mapping], depth: Any) -> list[list[int]]:
    """The places of settings that differ in ``depth`` alone, the deepest of each group first."""
    groups: dict[tuple, list[int]] = {}
    for i, s in enumerate(settings):
        groups.setdefault(tuple((str(k), v) for k, v in s.items() if k != depth), []).append(i)
    return [sorted(g, key=lambda i: -settings[i][depth]) for g in groups.values()]


def _one_tree(estimator, evaluator) -> bool:
    """Whether a deep model cut short stands for a shallow one, and the predictions are all that is measured."""
    return isinstance(estimator, DecisionTreeClassifier | DecisionTreeRegressor) and isinstance(
        evaluator, MulticlassClassificationEvaluator | RegressionEvaluator
    )


def _forest_groups(estimator, maps: Sequence[Mapping], evaluator, rows: DataFrame) -> list[list[int]] | None:
    """Settings of a forest that one training serves, if raw predictions are measured: those that differ in depth alone."""
    if not (isinstance(estimator, RandomForestClassifier) and isinstance(evaluator, BinaryClassificationEvaluator)):
        return None
    depth, first = estimator.maxDepth, rows.select(estimator.getFeaturesCol()).first()
    if first is None or not all(depth in m for m in maps):
        return None
    groups = []
    for group in _by_depth(maps, depth):
        setting = estimator.copy(maps[group[0]])
        shallow = [maps[i][depth] for i in group[1:]]
        same = not shallow or same_when_cut(setting, setting.getNumTrees(), setting.getMaxBins(), max(shallow), len(first[0]))
        groups += [group] if same else [[i] for i in group]
    return groups


def _measured(estimator, maps: Sequence[Mapping], evaluator, train: DataFrame, validation: DataFrame, parallelism: int) -> list[float]:
    """The metric of every setting trained on one part and measured on the other.

    Single trees that differ in depth alone are one training, of the deepest; so are forests.
    """
    def forest(group: list[int], depth) -> Callable[[], list[float]]:
        def run() -> list[float]:
            model = estimator.fit(train, maps[group[0]])
            depths = [maps[i][depth] for i in group]
            raws = [f"raw{i}" for i in range(len(depths))]
            scored = forest_scores(model, validation, depths, model.getFeaturesCol()).select(evaluator.getLabelCol(), *raws)
            with held(scored):
                return [evaluator.evaluate(scored, {evaluator.rawPredictionCol: raw}) for raw in raws]

        return run

    def job(setting: Mapping) -> Callable[[], list[float]]:
        return lambda: [evaluator.evaluate(estimator.fit(train, setting).transform(validation, setting))]

    def deepest(group: list[int], depth) -> Callable[[], list[float]]:
        def run() -> list[float]:
            models = CutTree.at_depths(estimator.fit(train, maps[group[0]]), train.sparkSession, [maps[i][depth] for i in group])
            return [evaluator.evaluate(model.transform(validation)) for model in models]

        return run

    groups, jobs = [[i] for i in range(len(maps))], [job(m) for m in maps]
    if _one_tree(estimator, evaluator) and all(estimator.maxDepth in m for m in maps):
        groups = _by_depth(maps, estimator.maxDepth)
        jobs = [deepest(group, estimator.maxDepth) for group in groups]
    with held(train), held(validation):
        forests = _forest_groups(estimator, maps, evaluator, train)
        if forests:
            groups = forests
            jobs = [forest(g, estimator.maxDepth) if len(g) > 1 else job(maps[g[0]]) for g in groups]
        done = in_threads(train.sparkSession, jobs, parallelism)
    found = dict(zip((i for group in groups for i in group), (x for metrics in done for x in metrics)))
    return [found[i] for i in range(len(maps))]


def _best_of(metrics: Sequence[float], evaluator) -> int:
    return int(np.argmax(metrics) if evaluator.isLargerBetter() else np.argmin(metrics))


def _trials(df: DataFrame, maps: Sequence[Mapping], metrics: Sequence[float]) -> DataFrame:
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in m.items()), float(x)) for i, (m, x) in enumerate(zip(maps, metrics))
    ]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, metric double")


def train_validation(
    stages: Sequence, estimator, grid: Mapping[str, Sequence], evaluator, train: DataFrame,
    ratio: float = 0.8, seed: int = 17, parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """Grid search on one split of ``train``, drawn as Spark's tuner draws it: the fitted pipeline with the best model, and the trials."""
    maps, fitted = param_maps(estimator, grid), Pipeline(stages=list(stages)).fit(train)
    rows = fitted.transform(train)
    drawn = rows.withColumn("_draw", F.rand(seed))
    metrics = _measured(estimator, maps, evaluator, drawn.filter(F.col("_draw") < ratio), drawn.filter(F.col("_draw") >= ratio), parallelism)
    best = TrainValidationSplitModel(estimator.fit(rows, maps[_best_of(metrics, evaluator)]), metrics)
    return PipelineModel([*fitted.stages, best]), _trials(train, maps, metrics)


def cross_validation(
    stages: Sequence, estimator, grid: Mapping[str, Sequence], evaluator, train: DataFrame,
    folds: int = 3, fold_column: str = "", seed: int = 17, parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """Grid search with k folds, drawn as Spark's tuner draws them; ``fold_column`` may name whole-number folds from 0."""
    maps, fitted = param_maps(estimator, grid), Pipeline(stages=list(stages)).fit(train)
    rows = fitted.transform(train)
    drawn, fold = rows.withColumn("_draw", F.rand(seed)), F.col(fold_column or "_draw")
    by_fold = []
    for i in range(folds):
        inside = fold == i if fold_column else (fold >= i / folds) & (fold < (i + 1) / folds)
        by_fold.append(_measured(estimator, maps, evaluator, drawn.filter(~inside), drawn.filter(inside), parallelism))
    metrics = np.mean(by_fold, axis=0).tolist()
    best = CrossValidatorModel(estimator.fit(rows, maps[_best_of(metrics, evaluator)]), metrics)
    return PipelineModel([*fitted.stages, best]), _trials(train, maps, metrics)


def full_grid(grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """Every combination, the last parameter varying fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def vary(fixed: Mapping[str, Any], name: str, values: Sequence) -> list[dict[str, Any]]:
    """One parameter over ``values``, the others fixed."""
    return [{**fixed, name: v} for v in values]


def vary_each(around: Mapping[str, Any], grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """Every parameter of ``grid`` over its values in turn, the others as in ``around``; each setting once, where it comes first."""
    settings: list[dict[str, Any]] = []
    for name, values in grid.items():
        settings += [s for s in vary(around, name, values) if s not in settings]
    return settings


@dataclass(frozen=True)
class Sweep:
    trials: DataFrame
    models: tuple

    def best(self, larger_is_better: bool = True):
        """The model of the best trial; the earliest of equals."""
        row = best_trial(self.trials, "metric", larger_is_better).first()
        return self.models[row["trial"]]


def sweep(
    train: DataFrame,
    validation: DataFrame,
    settings: Sequence[Mapping[str, Any]],
    train_one: Callable[..., Any],
    measure: Callable[[DataFrame], DataFrame],
    parallelism: int = 4,
    depth: str = "",
) -> Sweep:
    """Train with every setting on one fixed split and report metric and seconds per trial.

    ``train_one(train, **setting)`` returns something with ``transform``; ``measure`` turns
    scored rows into a one-value DataFrame. ``depth`` names the depth of a single tree that sees all rows and features: settings
    that differ in it alone are one training, of the deepest, cut at each depth; its seconds count for each of them.
    """
    def run(group: list[int]) -> list[tuple[Any, float | None, float]]:
        began = monotonic()
        models = [train_one(train, **settings[group[0]])]
        if len(group) > 1:
            models = CutTree.at_depths(models[0], train.sparkSession, [settings[i][depth] for i in group])
        trained, found = monotonic() - began, []
        for model in models:
            began = monotonic()
            metric = measure(model.transform(validation)).first()[0]
            found.append((model, metric, trained + monotonic() - began))
        return found

    groups = _by_depth(settings, depth) if depth else [[i] for i in range(len(settings))]
    with held(train), held(validation):
        results = in_threads(train.sparkSession, [partial(run, g) for g in groups], parallelism)
    placed = {i: r for group, results_ in zip(groups, results) for i, r in zip(group, results_)}
    done = [placed[i] for i in range(len(settings))]
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in s.items()), None if m is None else float(m), d)
        for i, (s, (_, m, d)) in enumerate(zip(settings, done))
    ]
    trials = train.sparkSession.createDataFrame(rows, "trial int, params string, metric double, seconds double")
    return Sweep(trials, tuple(model for model, _, _ in done))


def best_trial(trials: DataFrame, metric: str = "metric", larger_is_better: bool = True) -> DataFrame:
    """The row with the best metric; the earliest trial of equals."""
    key = F.desc_nulls_last(metric) if larger_is_better else F.asc_nulls_last(metric)
    return trials.orderBy(key, "trial").limit(1)
