"""Model metrics as one-row DataFrames, and the matching ML evaluators."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import absolute_error, is_hit
from tallyframe.operators.ordering import ROWS_PER_RANGE, running_sums


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), F.lit(2.0)))).alias("rmse"))


def auc_of_classes(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Area under ROC of predicted classes 0 and 1: the mean of both hit rates.

    NULL when the labels are all of one class.
    """
    hit = (F.col(prediction) == F.col(label)).cast("double")
    positive = F.avg(F.when(F.col(label) == 1, hit))
    negative = F.avg(F.when(F.col(label) == 0, hit))
    return df.agg(((positive + negative) / 2).alias("auc"))


def auc_of_scores(
    df: DataFrame, score: str = "score", label: str = "label", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Exact area under ROC of scores: the share of (positive, negative) pairs in right order, ties half.

    Rows are first counted per distinct score. The counts below a score come from running
    totals over score ranges, so neither a common score nor many scores load one task.
    """
    rows = df.count()
    one = F.col(label) == 1
    per_score = df.groupBy(score).agg(
        F.count_if(one).cast("double").alias("_pos"), F.count_if(~one).cast("double").alias("_neg")
    )
    below = running_sums(per_score, [score], {"_upto": F.col("_neg")}, rows, rows_per_range)
    ordered = F.sum(F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2))
    pairs = F.sum("_pos") * F.sum("_neg")
    return below.agg(F.try_divide(ordered, pairs).alias("auc"))


def auc_of_model(scored: DataFrame, raw: str = "rawPrediction", label: str = "label") -> DataFrame:
    """Area under ROC of a binary classifier's raw prediction for class 1."""
    score = vector_to_array(F.col(raw))[1].alias("_score")
    return auc_of_scores(scored.select(score, label), "_score", label)


def residuals(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Add the absolute error and whether the whole-number prediction is right."""
    return df.withColumns({"error": absolute_error(label, prediction), "hit": is_hit(label, prediction)})


def binary_evaluator(label: str = "label", raw: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under ROC; pass ``raw="prediction"`` for the area of predicted classes."""
    return BinaryClassificationEvaluator(
        rawPredictionCol=raw, labelCol=label, metricName="areaUnderROC", numBins=0
    )


def accuracy_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


def rmse_evaluator(label: str = "label") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
