"""Feature preparation as ML pipeline stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_indexer(category: str, unseen: str = "error") -> StringIndexer:
    """Category to index: most frequent first, ties by name. An unseen category raises by default."""
    return StringIndexer(inputCol=category, outputCol=f"{category}_index", handleInvalid=unseen)


def category_encoder(category: str) -> OneHotEncoder:
    """Index to one-hot vector with a place for every category."""
    return OneHotEncoder(inputCol=f"{category}_index", outputCol=f"{category}_vec", dropLast=False)


def category_size(fitted: PipelineModel) -> int:
    """Places of the one-hot vector of a fitted ``category_encoder``."""
    return next(s.categorySizes[0] for s in fitted.stages if isinstance(s, OneHotEncoderModel))


def category_stages(category: str, numeric: Sequence[str], output: str = "features", unseen: str = "error") -> list:
    """Index and one-hot the category, then assemble it with the numeric columns."""
    return [
        category_indexer(category, unseen),
        category_encoder(category),
        VectorAssembler(inputCols=[f"{category}_vec", *numeric], outputCol=output),
    ]


def placed(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """One row per place of a vector column, from 0, with its value."""
    return df.select(*keys, F.posexplode(vector_to_array(vector)).alias("place", "value"))


def numeric_stages(numeric: Sequence[str], output: str = "features") -> list:
    return [VectorAssembler(inputCols=list(numeric), outputCol=output)]


def indexed_stages(
    numeric: Sequence[str], max_categories: int = 24, output: str = "features", unseen: str = "error"
) -> list:
    """Assemble, then treat every feature with at most ``max_categories`` values as categorical.

    A value of such a feature that was not there when fitting raises by default; with
    ``unseen="keep"`` all of them are one category more.
    """
    return [
        VectorAssembler(inputCols=list(numeric), outputCol="aFeatures"),
        VectorIndexer(inputCol="aFeatures", outputCol=output, maxCategories=max_categories, handleInvalid=unseen),
    ]


def scaler(with_mean: bool = True, source: str = "features", output: str = "scaled") -> StandardScaler:
    """Divide by the sample deviation, optionally after subtracting the mean; a constant column gives 0."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=with_mean, withStd=True)


def unpack(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Spread a vector column over double columns and drop it."""
    kept = [c for c in df.columns if c != vector and c not in names]
    values = df.withColumn("_values", vector_to_array(F.col(vector)))
    return values.select(*kept, *[F.col("_values")[i].alias(n) for i, n in enumerate(names)])


def scaled_columns(df: DataFrame, columns: Sequence[str], with_mean: bool = True) -> DataFrame:
    """What ``scaler`` computes, on plain columns: one pass for the moments, then arithmetic in the scan."""
    moments = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()

    def scale(c: str):
        deviation = moments[f"s_{c}"]
        if not deviation:
            return F.when(F.col(c).isNotNull(), 0.0)
        shift = (moments[f"m_{c}"] or 0.0) if with_mean else 0.0
        return (F.col(c) - F.lit(shift)) / F.lit(deviation)

    return df.withColumns({c: scale(c) for c in columns})


def category_index(df: DataFrame, category: str) -> DataFrame:
    """The fitted dictionary with counts: category, index, rows."""
    fitted: Transformer = category_indexer(category).fit(df)
    counted = df.groupBy(category).agg(F.count("*").alias("counts"))
    indexed = fitted.transform(counted)
    return indexed.select(category, F.col(f"{category}_index").cast("int").alias("category_index"), "counts")
