"""Loaders for the file layouts the reports and models start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.columns import cast_columns, clean_numeric, shift_label
from tallyframe.sources.text import read_delimited, read_positional

USERS = "userid int, age int, gender string, occupation string, zipcode string"
ZIPCODES = "zipcode string, zipCodeType string, city string, state string"
RATINGS = "user int, item int, rating float"
TITLES = "item int, title string"

# Hourly rental columns that are neither features nor label.
HOURLY_UNUSED = ["instant", "dteday", "yr", "casual", "registered"]


def load_users(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated, no header."""
    return read_delimited(spark, path, "|", USERS)


def load_zipcodes(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated, quoted, with header; the first four columns, zip code as int."""
    raw = read_delimited(spark, path, ",", header=True)
    first4 = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))]).select("c0", "c1", "c2", "c3")
    return first4.toDF("zipcode", "zipCodeType", "city", "state").withColumn("zipcode", F.col("zipcode").cast("int"))


def load_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated user, item, rating, time; the time is not read."""
    return read_delimited(spark, path, "\t", RATINGS + ", rated_at long").select("user", "item", "rating")


def load_titles(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated item list; only id and title are used."""
    raw = read_positional(spark, path, "|")
    return raw.select(F.col("f0").cast("int").alias("item"), F.col("f1").alias("title"))


def load_pages(spark: SparkSession, path: str, first_numeric: int = 4) -> DataFrame:
    """Tab-separated page list with header: url, category, numeric columns with ``?``.

    With a label it is the last numeric column.
    """
    raw = read_delimited(spark, path, "\t", header=True)
    numeric = raw.columns[first_numeric:]
    return clean_numeric(raw.select("url", "alchemy_category", *numeric), numeric)


def load_cover(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated numeric records, the last field is a class from 1: ``f0..``, ``label`` from 0."""
    raw = read_positional(spark, path)
    last = raw.columns[-1]
    return cast_columns(raw, raw.columns).withColumn("label", shift_label(last)).drop(last)


def load_hourly(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Hourly rentals with header; features and the label ``cnt`` as doubles, ``key`` kept as text."""
    raw = read_delimited(spark, path, ",", header=True).drop(*[c for c in HOURLY_UNUSED if c != key])
    return cast_columns(raw, [c for c in raw.columns if c != key])
