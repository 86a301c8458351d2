"""Word counting over text lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines_of(df: DataFrame, column: str) -> DataFrame:
    """One row ``value`` per line of a text column."""
    return df.select(F.explode(F.split(column, "\n", -1)).alias("value"))


def space_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row ``word`` per piece between single spaces; empty ones count."""
    return lines.select(F.explode(F.split(column, " ", -1)).alias("word"))


def token_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row ``word`` per run of other than space, tab, newline, return and form feed."""
    pieces = lines.select(F.explode(F.split(column, "[ \\t\\n\\r\\f]+", -1)).alias("word"))
    return pieces.filter(F.col("word") != "")


Splitter = Callable[[DataFrame, str], DataFrame]


def word_count(lines: DataFrame, words: Splitter = space_words, column: str = "value") -> DataFrame:
    """``word, counts``. Counts are combined before the shuffle, so a frequent word is no hot spot."""
    return words(lines, column).groupBy("word").agg(F.count("*").alias("counts"))


def vocabulary_size(lines: DataFrame, words: Splitter = space_words, column: str = "value") -> DataFrame:
    """One row: the number of different words."""
    return word_count(lines, words, column).agg(F.count("*").alias("words"))
