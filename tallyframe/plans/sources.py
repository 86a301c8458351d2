"""Writes of the tables in text layouts, read back through the text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import cast_columns
from tallyframe.operators.text import word_count
from tallyframe.plans.registry import query
from tallyframe.plans.relational import PAGES, SPACED, USERS, WORDS
from tallyframe.plans.tables import LINE_NUMBERS, Tables
from tallyframe.session import fresh_path
from tallyframe.sources import layouts, sinks, text


@query("src_text_lines", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def src_text_lines(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "lines")
    sinks.write_lines(t("documents"), path, ["text"])
    return text.read_lines(t.spark, path)


@query("src_delimited_roundtrip", USERS + "SELECT * FROM users")
def src_delimited_roundtrip(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "users")
    sinks.write_delimited(t.users(), path, "|")
    return layouts.load_users(t.spark, path)


@query("src_header_csv_roundtrip", PAGES + "SELECT * FROM pages_")
def src_header_csv_roundtrip(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "pages")
    sinks.write_delimited(t.raw_pages(), path, "\t", header=True, quote_all=True)
    return layouts.load_pages(t.spark, path, first_numeric=2)


@query("src_strip_header", USERS + "SELECT CAST(userid AS VARCHAR) AS userid, occupation FROM users")
def src_strip_header(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "headed")
    sinks.write_delimited(t.users(), path, ",", header=True)
    lines = text.strip_header(text.read_lines(t.spark, path), "userid,age,gender,occupation,zipcode")
    fields = lines.select(text.split_fields("value", ",").alias("a"))
    return fields.select(F.col("a")[0].alias("userid"), F.col("a")[3].alias("occupation"))


@query("src_strip_quotes", USERS + "SELECT CAST(userid AS VARCHAR) AS userid, zipcode FROM users")
def src_strip_quotes(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "quoted")
    sinks.write_delimited(t.users(), path, ",", quote_all=True)
    fields = text.read_lines(t.spark, path).select(text.split_fields(text.strip_quotes("value"), ",").alias("a"))
    return fields.select(F.col("a")[0].alias("userid"), F.col("a")[4].alias("zipcode"))


@query("src_typed_users", USERS + "SELECT CAST(userid AS INT) AS userid, age, gender, occupation, zipcode FROM users")
def src_typed_users(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "user-lines")
    sinks.write_lines(t.users(), path, ["userid", "age", "gender", "occupation", "zipcode"], "|")
    fields = text.positional_fields(text.read_lines(t.spark, path), "|")
    return fields.toDF("userid", "age", "gender", "occupation", "zipcode").withColumns(
        {"userid": F.col("userid").cast("int"), "age": F.col("age").cast("int")}
    )


@query(
    "src_positional_schema",
    "SELECT " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(LINE_NUMBERS)) + " FROM lineitem",
)
def src_positional_schema(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "fields")
    sinks.write_delimited(t("lineitem").select(*LINE_NUMBERS), path, ",")
    raw = text.read_positional(t.spark, path)
    return cast_columns(raw, raw.columns)


@query("snk_text_roundtrip", WORDS + "," + SPACED + "SELECT word, count(*) AS counts FROM words GROUP BY word")
def snk_text_roundtrip(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "counts")
    sinks.write_lines_once(word_count(t.text_lines()), path, ["word", "counts"])
    fields = text.read_lines(t.spark, path).select(text.split_fields("value", "\t").alias("a"))
    return fields.select(F.col("a")[0].alias("word"), F.col("a")[1].cast("long").alias("counts"))
