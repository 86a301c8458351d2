"""Classifiers and regressors with their usual settings, training and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import code_to_text
from tallyframe.operators.holding import held

SEED = 17


def tree_classifier(impurity: str = "gini", depth: int = 10, bins: int = 14, **more) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        labelCol="label", featuresCol="features", impurity=impurity, maxDepth=depth, maxBins=bins, seed=SEED, **more
    )


def forest_classifier(trees: int = 10, **more) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, seed=SEED, **more)


def logistic_classifier(features: str = "scaled", **more) -> LogisticRegression:
    return LogisticRegression(labelCol="label", featuresCol=features, **more)


def svm_classifier(features: str = "scaled", iterations: int = 25, **more) -> LinearSVC:
    return LinearSVC(labelCol="label", featuresCol=features, maxIter=iterations, **more)


def bayes_classifier(smoothing: float = 60.0, features: str = "scaled") -> NaiveBayes:
    """Multinomial; the features must not be negative."""
    return NaiveBayes(labelCol="label", featuresCol=features, smoothing=smoothing, modelType="multinomial")


def tree_regressor(label: str = "cnt", **more) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, featuresCol="features", seed=SEED, **more)


def boosted_regressor(label: str = "cnt", **more) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol="features", seed=SEED, **more)


def fit(stages: Sequence, estimator, train: DataFrame) -> PipelineModel:
    """Fit the preparation stages and the estimator on ``train``, kept in memory or on disk meanwhile."""
    with held(train):
        return Pipeline(stages=[*stages, estimator]).fit(train)


def describe(scored: DataFrame, texts: Mapping[int, str], prediction: str = "prediction") -> DataFrame:
    """Add the text that belongs to the predicted class."""
    return scored.withColumn("description", code_to_text(prediction, texts))


def rules(model) -> str:
    """The rules of a fitted tree or forest as text."""
    return model.toDebugString


def bayes_parameters(model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """One row per class and feature: log prior and log probability. Classes x features rows."""
    theta = model.theta.toArray()
    rows = [
        (float(c), name, float(model.pi[c]), float(theta[c][j]))
        for c in range(theta.shape[0])
        for j, name in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "label double, feature string, pi double, theta double")


def importances(model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """One row per feature of a fitted tree model."""
    rows = [(name, float(model.featureImportances[j])) for j, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))
