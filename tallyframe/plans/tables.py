"""The stored tables, and the frames that queries derive from them.

Every derived frame has its SQL text beside it; both state the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_NUMBERS = ["n_chars", "n_words", "n_lines", "n_digits"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
HOUR_FEATURES = [
    "season", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit", "temp", "atemp", "hum", "windspeed",
]
VECTOR_SIZE = 64

USERS_SQL = """
SELECT c_custkey AS userid, CAST(18 + c_custkey % 60 AS INT) AS age,
       CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS occupation,
       CASE WHEN c_custkey % 50 = 0 THEN 'X' || c_nationkey
            ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zipcode
FROM customer"""

ZIPCODES_SQL = """
SELECT n_nationkey AS zipcode, 'STANDARD' AS zipCodeType, r_name AS city, n_name AS state
FROM nation JOIN region ON n_regionkey = r_regionkey"""

PAGES_SQL = """
SELECT CAST(d.doc_id AS VARCHAR) AS url, lang AS alchemy_category,
       CASE WHEN d.doc_id % 7 = 0 THEN 0.0 ELSE CAST(n_chars AS DOUBLE) END AS n_chars,
       CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words,
       CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines,
       CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) AS n_digits,
       CAST(quality AS DOUBLE) AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

#: All documents; the label of one without is NULL.
ALL_PAGES_SQL = PAGES_SQL.replace("JOIN labels", "LEFT JOIN labels")

HOURS_SQL = """
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) // 3600 AS instant,
       strftime(date_trunc('hour', ts), '%Y-%m-%d') AS dteday,
       quarter(date_trunc('hour', ts)) AS season, year(date_trunc('hour', ts)) AS yr,
       month(date_trunc('hour', ts)) AS mnth, hour(date_trunc('hour', ts)) AS hr,
       CASE WHEN isodow(date_trunc('hour', ts)) = 7 THEN 1 ELSE 0 END AS holiday,
       isodow(date_trunc('hour', ts)) - 1 AS weekday,
       CASE WHEN isodow(date_trunc('hour', ts)) <= 5 THEN 1 ELSE 0 END AS workingday,
       1 + count(*) FILTER (event_type = 'error') % 4 AS weathersit,
       sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / count(*) / 100000 AS temp,
       min(value) / 1000 AS atemp, max(value) / 1000 AS hum,
       coalesce(max(value) FILTER (event_type = 'click'), 0) / 1000 AS windspeed,
       count(*) FILTER (event_type = 'signup') AS casual,
       count(*) - count(*) FILTER (event_type = 'signup') AS registered, count(*) AS cnt
FROM events GROUP BY date_trunc('hour', ts)"""

RATINGS_SQL = """
SELECT CAST(o_custkey AS INT) AS "user", CAST(l_partkey AS INT) AS item,
       CAST(1 + max(l_quantity) % 5 AS FLOAT) AS rating, min(l_orderkey) AS first_order
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey"""

WORDS_SQL = """
SELECT unnest(string_split(replace(text, '. ', '.  '), chr(10))) AS value FROM documents"""

SCORED_SQL = """
SELECT event_id, value AS score, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
       CASE WHEN value > 50 THEN 1 ELSE 0 END AS prediction
FROM events"""


class Tables:
    """Parquet tables under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def users(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
        return self("customer").select(
            key.alias("userid"),
            (18 + key % 60).cast("int").alias("age"),
            F.when(key % 3 == 0, "F").otherwise("M").alias("gender"),
            F.col("c_mktsegment").alias("occupation"),
            F.when(key % 50 == 0, F.concat(F.lit("X"), nation)).otherwise(F.lpad(nation, 5, "0")).alias("zipcode"),
        )

    def zipcodes(self) -> DataFrame:
        nation = self("nation").join(self("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return nation.select(
            F.col("n_nationkey").alias("zipcode"),
            F.lit("STANDARD").alias("zipCodeType"),
            F.col("r_name").alias("city"),
            F.col("n_name").alias("state"),
        )

    def raw_pages(self, labelled: bool = True) -> DataFrame:
        """Labelled pages, or all, as text, with ``?`` for a missing number. Texts are measured before the join."""
        measured = self("documents").select(
            "doc_id",
            F.col("lang").alias("alchemy_category"),
            F.when(F.col("doc_id") % 7 == 0, "?").otherwise(F.col("n_chars").cast("string")).alias("n_chars"),
            F.size(F.split("text", " ", -1)).cast("string").alias("n_words"),
            F.size(F.split("text", "\n", -1)).cast("string").alias("n_lines"),
            F.length(F.regexp_replace("text", "[^0-9]", "")).cast("string").alias("n_digits"),
        )
        labels = self("labels").select("doc_id", F.col("quality").cast("string").alias("label"))
        return measured.join(labels, "doc_id", "inner" if labelled else "left").select(
            F.col("doc_id").cast("string").alias("url"), "alchemy_category", *PAGE_NUMBERS, "label"
        )

    def vectors(self) -> DataFrame:
        """Embedding values as text fields ``f0..``, the last field being a class from 1."""
        values = [F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(VECTOR_SIZE)]
        last = (F.col("label") + 1).cast("double").alias(f"f{VECTOR_SIZE}")
        return self("embeddings").select("vec_id", *values, last)

    def hours(self) -> DataFrame:
        """Events per hour in the layout of the hourly rentals."""
        kind = F.col("event_type")
        hour = F.col("hour")
        counted = self("events").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")).agg(
            F.count_if(kind == "error").alias("errors"),
            # whole cents, so that the sum does not depend on the order of its terms
            F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"),
            F.min("value").alias("least"),
            F.max("value").alias("most"),
            F.max(F.when(kind == "click", F.col("value"))).alias("clicked"),
            F.count_if(kind == "signup").alias("casual"),
            F.count("*").alias("cnt"),
        )
        return counted.select(
            (F.unix_date(F.to_date(hour)).cast("long") * 24 + F.hour(hour)).alias("instant"),
            F.date_format(hour, "yyyy-MM-dd").alias("dteday"),
            F.quarter(hour).alias("season"),
            F.year(hour).alias("yr"),
            F.month(hour).alias("mnth"),
            F.hour(hour).alias("hr"),
            F.when(F.weekday(hour) == 6, 1).otherwise(0).alias("holiday"),
            F.weekday(hour).alias("weekday"),
            F.when(F.weekday(hour) < 5, 1).otherwise(0).alias("workingday"),
            (1 + F.col("errors") % 4).alias("weathersit"),
            (F.col("cents").cast("double") / F.col("cnt") / 100000).alias("temp"),
            (F.col("least") / 1000).alias("atemp"),
            (F.col("most") / 1000).alias("hum"),
            (F.coalesce("clicked", F.lit(0.0)) / 1000).alias("windspeed"),
            "casual",
            (F.col("cnt") - F.col("casual")).alias("registered"),
            "cnt",
        )

    def ratings(self) -> DataFrame:
        """One rating per user and item, with the first order number as its place in time."""
        sold = self("orders").join(self("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        return sold.groupBy(
            F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item")
        ).agg(
            (1 + F.max("l_quantity") % 5).cast("float").alias("rating"),
            F.min("l_orderkey").alias("first_order"),
        )

    def titles(self) -> DataFrame:
        return self("part").select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"))

    def text_lines(self) -> DataFrame:
        """Lines of the documents, with double spaces after sentences."""
        text = F.replace(F.col("text"), F.lit(". "), F.lit(".  "))
        return self("documents").select(F.explode(F.split(text, "\n", -1)).alias("value"))

    def scored(self) -> DataFrame:
        return self("events").select(
            "event_id",
            F.col("value").alias("score"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"),
            F.when(F.col("value") > 50, 1).otherwise(0).alias("prediction"),
        )
