import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyframe.operators import evaluate as E
from tallyframe.operators import features as V


def test_category_order_and_one_hot(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("?",), ("c",)], "cat string")
    index = {r.cat: r.category_index for r in V.category_index(df, "cat").collect()}
    assert index == {"b": 0, "?": 1, "a": 2, "c": 3}
    stages = V.category_stages("cat", [])
    coded = Pipeline(stages=stages[:2]).fit(df).transform(df)
    rows = {r.cat: r.v for r in coded.select("cat", vector_to_array("cat_vec").alias("v")).collect()}
    assert rows["c"] == [0.0, 0.0, 0.0, 1.0]


def test_unseen_category_raises_or_is_kept(spark):
    df = spark.createDataFrame([("a",)], "cat string")
    other = spark.createDataFrame([("z",)], "cat string")
    with pytest.raises(Exception, match="Unseen"):
        V.category_indexer("cat").fit(df).transform(other).collect()
    assert V.category_indexer("cat", "keep").fit(df).transform(other).first()["cat_index"] == 1.0


def test_null_number_does_not_assemble(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception, match="null"):
        V.numeric_stages(["x"])[0].transform(df).collect()


@pytest.mark.parametrize("with_mean", [True, False])
def test_both_scalers_agree(spark, tables, with_mean):
    names = ["l_quantity", "l_tax", "same"]
    df = tables("lineitem").select("l_quantity", "l_tax", F.lit(4.0).alias("same"))
    vectors = V.numeric_stages(names)[0].transform(df)
    fitted = V.scaler(with_mean).fit(vectors).transform(vectors).select("scaled")
    one = V.unpack(fitted, "scaled", names)
    two = V.scaled_columns(df, names, with_mean)
    a, b = (x.agg(*[F.sum(F.col(n) * (i + 2)) for i, n in enumerate(names)], F.max("l_tax")).first() for x in (one, two))
    assert tuple(a) == pytest.approx(tuple(b), abs=1e-6)
    assert a[2] == 0.0


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_range", [11, 10_000])
def test_auc_of_scores(spark, per_range):
    rng = random.Random(2)
    # a third of the rows share one score
    rows = [(5.0 if i % 3 == 0 else float(rng.randint(0, 40)), rng.randint(0, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert E.auc_of_scores(df, rows_per_range=per_range).first()[0] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert E.binary_evaluator(raw="score").evaluate(df) == pytest.approx(brute_auc(rows), abs=1e-9)


def test_auc_of_classes_is_the_area_of_hard_predictions(spark):
    rows = [(1.0, 1), (0.0, 1), (0.0, 0), (1.0, 0), (0.0, 0)]
    df = spark.createDataFrame(rows, "prediction double, label int")
    area = E.auc_of_classes(df).first()[0]
    assert area == pytest.approx((1 / 2 + 2 / 3) / 2)
    assert area == pytest.approx(E.binary_evaluator(raw="prediction").evaluate(df))
    assert area == pytest.approx(E.auc_of_scores(df, "prediction").first()[0])


def test_metrics_without_a_second_class_or_rows(spark):
    one = spark.createDataFrame([(1.0, 1)], "prediction double, label int")
    assert E.auc_of_classes(one).first()[0] is None
    assert E.auc_of_scores(one, "prediction").first()[0] is None
    assert E.accuracy(one.limit(0)).first()[0] is None


def test_accuracy_and_rmse_match_the_evaluators(spark, tables):
    df = tables("lineitem").select(
        F.col("l_quantity").alias("label"), F.floor(F.col("l_quantity") * 1.01).cast("double").alias("prediction")
    )
    assert E.accuracy(df).first()[0] == pytest.approx(E.accuracy_evaluator().evaluate(df))
    assert E.rmse(df).first()[0] == pytest.approx(E.rmse_evaluator().evaluate(df))
