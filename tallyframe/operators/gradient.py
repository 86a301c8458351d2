"""Linear classifiers trained by (mini-batch) gradient steps, many settings in lockstep.

One job per step serves every setting: each task multiplies its rows with the matrix of all current weights
and sums the gradients of all runs at once; per run only one number per feature, and a row count,
reach the driver. Settings that differ in the number of steps alone are one run, looked at after fewer steps.

The rows of a mini-batch follow from a hash of row key and step, so they are the same under
every partitioning. Rows with a null feature or label are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.holding import held
from tallyframe.operators.splits import key_bucket

#: Mini-batch fractions are counted in so many parts.
DRAWS = 1000

#: (margins, labels) to the slope of the loss in the margin; both broadcast.
Slope = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _margin(features: Sequence[str], weights: Sequence[float]) -> Column:
    return reduce(add, [F.col(f) * F.lit(float(w)) for f, w in zip(features, weights)])


def logistic_slope(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-margin)) - label


def hinge_slope(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    side = 2.0 * label - 1.0
    return np.where(side * margin < 1.0, -side, 0.0)


@dataclass(frozen=True)
class LinearModel:
    """Weights without intercept; a positive margin means class 1."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    steps: int

    def transform(self, df: DataFrame) -> DataFrame:
        margin = _margin(self.features, self.weights)
        return df.withColumns({"margin": margin, "prediction": F.when(margin > 0, 1.0).otherwise(0.0)})

    def as_rows(self, df: DataFrame) -> DataFrame:
        rows = list(zip(self.features, self.weights))
        return df.sparkSession.createDataFrame(rows, "feature string, weight double")


@dataclass(frozen=True)
class Descent:
    """Step ``t`` moves by ``step / sqrt(t)`` along the mean gradient of its batch and shrinks by ``reg``."""

    iterations: int
    step: float
    reg: float = 0.01
    fraction: float = 1.0

    @property
    def run(self) -> tuple[float, float, float]:
        return self.step, self.reg, self.fraction


def _matrix(batch: pa.RecordBatch, first: int, last: int) -> np.ndarray:
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(first, last)]
    return np.stack(columns, axis=1) if columns else np.zeros((batch.num_rows, 0))


def _gradient_sums(size: int, weights: np.ndarray, parts: np.ndarray, slope: Slope):
    """Rows (features, label, draw) to one row per run: the sums of its gradient, then its number of rows."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(weights), size + 1))
        for batch in batches:
            x, label = _matrix(batch, 0, size), batch.column(size).to_numpy(zero_copy_only=False)
            drawn = batch.column(size + 1).to_numpy(zero_copy_only=False)[:, None] < parts
            pull = np.where(drawn, slope(x @ weights.T, label[:, None]), 0.0)
            sums[:, :size] += pull.T @ x
            sums[:, size] += drawn.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums.tolist())], ["run", "sums"])

    return add_up


def descend_all(
    df: DataFrame,
    features: Sequence[str],
    slope: Slope,
    settings: Sequence[Descent],
    tolerance: float = 0.001,
    label: str = "label",
    key: Sequence[str] = (),
) -> list[LinearModel]:
    """One model per setting.

    A run stops early when a step changes the weights by less than ``tolerance`` of their length. ``key`` names the
    columns that tell rows apart in the choice of mini-batches; without them it is the features and the label.
    """
    names = list(features)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in (key or [*names, label])])
    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate([*names, label])]
    # every step goes over all rows, so they are dealt to all cores once: a table of numbers often lies in a few files
    rows = df.select(*columns, text.alias("key")).dropna().repartition(df.sparkSession.sparkContext.defaultParallelism)
    longest: dict[tuple, int] = {}
    for setting in settings:
        longest[setting.run] = max(setting.iterations, longest.get(setting.run, 0))
    # the weights of every run after 0, 1, ... steps; a run that has stopped gets no more
    paths = {run: [(0, np.zeros(len(names)))] for run in longest}
    going = set(longest)
    with held(rows):
        for t in range(1, max(longest.values(), default=0) + 1):
            runs = [run for run in longest if run in going and t <= longest[run]]
            if not runs:
                break
            parts = np.array([round(fraction * DRAWS) for _, _, fraction in runs])
            weights = np.stack([paths[run][-1][1] for run in runs])
            drawn = rows.withColumn("step", F.lit(str(t))).withColumn("draw", key_bucket("key", "step", buckets=DRAWS))
            if (parts >= DRAWS).all():
                drawn = rows.withColumn("draw", F.lit(0))
            inputs = drawn.select(*[f"x{i}" for i in range(len(names) + 1)], "draw")
            partial = inputs.mapInArrow(_gradient_sums(len(names), weights, parts, slope), "run int, sums array<double>")
            summed = partial.select("run", F.posexplode("sums").alias("place", "part")).groupBy("run", "place").agg(F.sum("part").alias("part"))
            sums = np.zeros((len(runs), len(names) + 1))
            for r in summed.collect():  # one number per run and feature
                sums[r["run"], r["place"]] = r["part"]
            for run, old, total in zip(runs, weights, sums):
                if not total[-1]:
                    paths[run].append((paths[run][-1][0], old))
                    continue
                rate = run[0] / math.sqrt(t)
                new = old * (1.0 - rate * run[1]) - rate * total[:-1] / total[-1]
                moved = paths[run][-1][0] > 0 and np.linalg.norm(new - old) < tolerance * max(np.linalg.norm(new), 1.0)
                paths[run].append((t, new))
                if moved:
                    going.discard(run)
    found = []
    for setting in settings:
        path = paths[setting.run]
        steps, weights = path[min(setting.iterations, len(path) - 1)]
        found.append(LinearModel(tuple(names), tuple(weights.tolist()), steps))
    return found


def descend(
    df: DataFrame, features: Sequence[str], slope: Slope, iterations: int, step: float, reg: float = 0.01,
    fraction: float = 1.0, **more,
) -> LinearModel:
    """The model of one setting."""
    return descend_all(df, features, slope, [Descent(iterations, step, reg, fraction)], **more)[0]


def _class_hits(size: int, weights: np.ndarray):
    """Rows (features, label) to counts per model and class: rows and right predictions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(weights), 2, 2), np.int64)
        for batch in batches:
            label = batch.column(size).to_numpy(zero_copy_only=False)
            above = _matrix(batch, 0, size) @ weights.T > 0
            for side in (0, 1):
                of_class = label == side
                counts[:, side, 0] += of_class.sum()
                counts[:, side, 1] += (above[of_class] == bool(side)).sum(axis=0)
        flat = counts.reshape(len(weights), 4)
        columns = [pa.array(range(len(flat)), pa.int32()), *(pa.array(flat[:, i]) for i in range(4))]
        yield pa.RecordBatch.from_arrays(columns, ["trial", "n0", "hit0", "n1", "hit1"])

    return count


def auc_of_models(models: Sequence[LinearModel], df: DataFrame, label: str = "label") -> DataFrame:
    """trial, metric: per model the area under ROC of its classes, NULL where the labels are all of one class; one pass."""
    names = list(models[0].features)
    rows = df.select(*[F.col(c).cast("double") for c in [*names, label]]).dropna()
    hits = _class_hits(len(names), np.array([m.weights for m in models]))
    counts = rows.mapInArrow(hits, "trial int, n0 long, hit0 long, n1 long, hit1 long").groupBy("trial")
    rates = [F.try_divide(F.sum(f"hit{side}"), F.sum(f"n{side}")) for side in (0, 1)]
    return counts.agg(((rates[0] + rates[1]) / 2).alias("metric"))


def logistic_sgd(df, features, iterations: int = 15, step: float = 10.0, fraction: float = 0.5, **more) -> LinearModel:
    return descend(df, features, logistic_slope, iterations, step, fraction=fraction, **more)


def svm_sgd(df, features, iterations: int = 3, step: float = 50.0, reg: float = 1.0, **more) -> LinearModel:
    return descend(df, features, hinge_slope, iterations, step, reg=reg, **more)
