"""Line-oriented and delimited text: reading, header and quote removal, typing."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``. ``path`` is any URI Spark can open."""
    return spark.read.text(path)


def read_delimited(
    spark: SparkSession, path: str, sep: str, schema: T.StructType | str | None = None, header: bool = False
) -> DataFrame:
    """Delimited text with a declared schema, or header-named all-string columns."""
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is not None:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    return reader.csv(path)


def strip_header(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Drop every line equal to the header; by default the header is the first line."""
    if header is None:
        first = lines.first()
        if first is None:
            return lines
        header = first["value"]
    return lines.filter(F.col("value") != header)


def strip_quotes(column: str | Column = "value") -> Column:
    return F.replace(F.col(column) if isinstance(column, str) else column, F.lit('"'), F.lit(""))


def split_fields(column: str | Column, sep: str) -> Column:
    """Array of the fields around a literal separator."""
    return F.split(column, re.escape(sep), -1)


def positional_fields(lines: DataFrame, sep: str, width: int | None = None) -> DataFrame:
    """String columns ``f0..fN`` by position; the first record gives the width."""
    fields = lines.select(split_fields("value", sep).alias("a"))
    if width is None:
        first = fields.first()
        width = 0 if first is None else len(first["a"])
    return fields.select([F.get("a", F.lit(i)).alias(f"f{i}") for i in range(width)])


def read_positional(spark: SparkSession, path: str, sep: str = ",", width: int | None = None) -> DataFrame:
    """``positional_fields`` through the CSV source, so that unused columns are not parsed.

    The CSV parser reads the first record for the width, so a separator within quotes does not count.
    """
    if width is None:
        width = len(spark.read.option("sep", sep).csv(path).columns)
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(width)])
    return read_delimited(spark, path, sep, schema)
