"""Whole jobs on files in the usual layouts, each a short composition of the operators.

Paths are URIs Spark can open. Jobs return DataFrames or fitted models; printing and
charts are left to the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import columns as C
from tallyframe.operators import evaluate as E
from tallyframe.operators import features as V
from tallyframe.operators import gradient as G
from tallyframe.operators import models as M
from tallyframe.operators import recommend as R
from tallyframe.operators import splits as S
from tallyframe.operators import text as X
from tallyframe.operators import tuning as U
from tallyframe.sources import layouts, sinks
from tallyframe.sources.text import read_delimited, read_lines


@dataclass(frozen=True)
class Trained:
    model: Any
    scored: DataFrame
    metric: DataFrame


def register_users(spark: SparkSession, users_path: str, zipcodes_path: str) -> tuple[DataFrame, DataFrame]:
    """Views ``user_table`` and ``zipcode_table`` for SQL, and both as DataFrames."""
    users, zipcodes = layouts.load_users(spark, users_path), layouts.load_zipcodes(spark, zipcodes_path)
    users.createOrReplaceTempView("user_table")
    zipcodes.createOrReplaceTempView("zipcode_table")
    return users, zipcodes


def count_words(spark: SparkSession, path: str, output: str, words: X.Splitter = X.space_words) -> bool:
    """Write ``word<TAB>count`` lines; False when ``output`` was there already."""
    return sinks.write_lines_once(X.word_count(read_lines(spark, path), words), output, ["word", "counts"])


def _numeric(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c not in ("url", "alchemy_category", "label")]


def classify_pages(spark: SparkSession, path: str, estimator=None) -> Trained:
    """Category and numbers of labelled pages into a binary classifier; area under ROC of its scores on the test part."""
    pages = layouts.load_pages(spark, path)
    train, test = S.halves(pages, ["url"], 70)
    stages = V.category_stages("alchemy_category", _numeric(pages))
    model = M.fit(stages, estimator or M.tree_classifier(), train)
    scored = model.transform(test)
    return Trained(model, scored, E.auc_of_model(scored))


def classify_pages_linearly(spark: SparkSession, path: str, train_model=G.logistic_sgd, **setting) -> Trained:
    """One-hot category and numbers, standardised on the training part, into gradient steps."""
    pages = layouts.load_pages(spark, path)
    train, test = S.halves(pages, ["url"], 70)
    prepared = _standardised(train, _numeric(pages))
    names = [f"x{i}" for i in range(prepared.stages[-1].mean.size)]
    model = train_model(V.unpack(prepared.transform(train).select("label", "scaled"), "scaled", names), names, **setting)
    ready = prepared.transform(test).select("url", "label", "scaled")
    scored = model.transform(V.unpack(ready, "scaled", names))
    return Trained(model, scored, E.auc_of_classes(scored))


def _standardised(train: DataFrame, numeric: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=[*V.category_stages("alchemy_category", numeric), V.scaler()]).fit(train)


def classify_pages_by_bayes(spark: SparkSession, path: str, smoothing: float = 60.0) -> Trained:
    pages = layouts.load_pages(spark, path)
    numeric = _numeric(pages)
    train, test = S.halves(pages.withColumns({c: C.clamp_nonnegative(c) for c in numeric}), ["url"], 70)
    stages = [*V.category_stages("alchemy_category", numeric), V.scaler(with_mean=False)]
    model = M.fit(stages, M.bayes_classifier(smoothing), train)
    scored = model.transform(test)
    return Trained(model, scored, E.auc_of_classes(scored))


def describe_pages(spark: SparkSession, path: str, model: PipelineModel) -> DataFrame:
    """url, prediction and description of unlabelled pages."""
    scored = model.transform(layouts.load_pages(spark, path))
    return M.describe(scored, C.PAGE_KINDS).select("url", "prediction", "description")


def classify_cover(spark: SparkSession, path: str, estimator=None) -> Trained:
    """Numeric records into a class from 0; accuracy on the test part.

    The records have no key, so the split is at random: copies of a record go to both parts.
    """
    cover = layouts.load_cover(spark, path)
    features = cover.columns[:-1]
    train, test = S.random_split(cover, [0.7, 0.3], seed=M.SEED)
    model = M.fit(V.numeric_stages(features), estimator or M.tree_classifier(depth=5, bins=20), train)
    scored = model.transform(test)
    return Trained(model, scored, E.accuracy(scored))


def describe_cover(scored: DataFrame) -> DataFrame:
    """The leading fields under their names, with label, prediction and whether it is right."""
    names = {f: name for f, name in C.COVER_NAMES.items() if f in scored.columns}
    return scored.withColumnsRenamed(names).select(
        *names.values(), "label", "prediction", C.is_hit("label", "prediction").alias("hit")
    )


def predict_rentals(spark: SparkSession, path: str, estimator=None) -> Trained:
    """Hourly features, small-valued ones as categories, into a count; RMSE on the test part."""
    hours = layouts.load_hourly(spark, path, key="instant")
    train, test = S.halves(hours, ["instant"], 70)
    features = [c for c in hours.columns if c not in ("instant", "cnt")]
    model = M.fit(V.indexed_stages(features), estimator or M.tree_regressor(), train)
    scored = model.transform(test)
    return Trained(model, scored, E.rmse(scored, label="cnt"))


def describe_rentals(scored: DataFrame) -> DataFrame:
    """Codes as text, readings in their units, and the prediction with its error."""
    texts = {
        "season": C.SEASONS, "holiday": C.HOLIDAYS, "weekday": C.WEEKDAYS,
        "workingday": C.WORKING_DAYS, "weathersit": C.WEATHER,
    }
    changed = {c: C.code_to_text(c, m) for c, m in texts.items() if c in scored.columns}
    changed |= {c: C.denormalise(c, m) for c, m in C.READING_MAXIMA.items() if c in scored.columns}
    told = E.residuals(scored, label="cnt").withColumns(changed)
    return told.drop("aFeatures", "features")


def sweep_page_trees(
    spark: SparkSession, path: str, grid: Mapping[str, Sequence] = U.TREE_SWEEP, parallelism: int = 4
) -> U.Sweep:
    """Train a tree per combination on 8/10 of the pages and measure it on 1/10."""
    pages = layouts.load_pages(spark, path)
    parted = S.hash_split(pages, ["url"], {"train": 80, "validation": 10, "test": 10})
    train, validation = (parted.filter(F.col("part") == p).drop("part") for p in ("train", "validation"))
    stages = V.category_stages("alchemy_category", _numeric(pages))

    def train_one(rows: DataFrame, **setting):
        return M.fit(stages, M.tree_classifier(**setting), rows)

    return U.sweep(train, validation, U.full_grid(grid), train_one, E.auc_of_classes, parallelism)


def train_recommender(spark: SparkSession, ratings_path: str, model_path: str, **setting) -> bool:
    """Factorise the ratings and save the model; False when there was one already."""
    return sinks.save_model_once(R.train_factors(layouts.load_ratings(spark, ratings_path), **setting), model_path)


def recommend(
    spark: SparkSession, model_path: str, titles_path: str, user: int | None = None, item: int | None = None, k: int = 10
) -> DataFrame:
    """The best items for a user, or the best users for an item, with titles."""
    if (user is None) == (item is None):
        raise ValueError("ask for a user or for an item")
    model, titles = R.load_model(model_path), layouts.load_titles(spark, titles_path)
    if user is not None:
        return R.items_for_users(model, spark.createDataFrame([(user,)], "user int"), titles, k)
    return R.users_for_items(model, spark.createDataFrame([(item,)], "item int"), titles, k)


RATED_AT = "position long, user int, item int, rating float, rated_at long"


def split_ratings(ratings: DataFrame, order: Sequence[str], folds: int = 5, max_test: int = 0) -> dict[str, DataFrame]:
    """Test and base parts: ``folds`` runs of the ordered ratings, then the first and second ten of each user.

    With ``max_test`` above 0 the last two test parts have at most so many rows, the first in ``order``. Every part is sorted by user and item.
    """
    folded = S.positional_folds(ratings, order, folds)
    parts = {}
    for i in range(1, folds + 1):
        parts[f"fold{i}.test"], parts[f"fold{i}.base"] = S.fold_test(folded, i), S.fold_base(folded, i)
    for name, start, stop in (("first", 1, 10), ("second", 11, 20)):
        marked = S.leave_n_out(ratings, "user", order, start, stop, max_test=max_test)
        parts[f"{name}.test"] = marked.filter("held_out").drop("held_out")
        parts[f"{name}.base"] = marked.filter("NOT held_out").drop("held_out")
    return {name: part.orderBy("user", "item") for name, part in parts.items()}


def load_ordered_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings with an explicit ``position`` as first field, for the splits by order."""
    return read_delimited(spark, path, "\t", RATED_AT)
