"""Projections, filters, joins, aggregates, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import columns as C
from tallyframe.operators import relational as R
from tallyframe.operators import text as X
from tallyframe.plans.registry import query
from tallyframe.plans.tables import (
    HOUR_FEATURES,
    HOURS_SQL,
    LINE_NUMBERS,
    PAGES_SQL,
    USERS_SQL,
    VECTOR_SIZE,
    WORDS_SQL,
    ZIPCODES_SQL,
    Tables,
)
from tallyframe.sources.layouts import HOURLY_UNUSED

USERS = f"WITH users AS ({USERS_SQL}) "
USERS_ZIP = f"WITH users AS ({USERS_SQL}), zipcodes AS ({ZIPCODES_SQL}) "
HOURS = f"WITH hours AS ({HOURS_SQL}) "
PAGES = f"WITH pages_ AS ({PAGES_SQL}) "
WORDS = f"WITH lines_ AS ({WORDS_SQL}) "
SPACED = "words AS (SELECT unnest(string_split(value, ' ')) AS word FROM lines_) "


@query("rel_count", "SELECT count(*) AS counts FROM customer")
def rel_count(t: Tables) -> DataFrame:
    return t.users().agg(F.count("*").alias("counts"))


@query("prj_columns", USERS + "SELECT userid, occupation, gender, age FROM users")
def prj_columns(t: Tables) -> DataFrame:
    return t.users().select("userid", "occupation", "gender", "age")


@query("prj_star", USERS + "SELECT * FROM users")
def prj_star(t: Tables) -> DataFrame:
    return t.users().select("*")


@query("prj_birthyear", USERS + "SELECT userid, occupation, gender, age, 2019 - age AS birthyear FROM users")
def prj_birthyear(t: Tables) -> DataFrame:
    return t.users().select("userid", "occupation", "gender", "age", C.birth_year("age", 2019).alias("birthyear"))


@query(
    "prj_bulk_cast",
    HOURS + "SELECT instant, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in HOUR_FEATURES) + " FROM hours",
)
def prj_bulk_cast(t: Tables) -> DataFrame:
    return C.cast_columns(t.hours().select("instant", *HOUR_FEATURES), HOUR_FEATURES)


@query("prj_missing_to_zero", PAGES + "SELECT * FROM pages_")
def prj_missing_to_zero(t: Tables) -> DataFrame:
    raw = t.raw_pages()
    return C.clean_numeric(raw, raw.columns[2:])


@query("prj_drop", HOURS + f"SELECT {', '.join(HOUR_FEATURES)}, cnt FROM hours")
def prj_drop(t: Tables) -> DataFrame:
    return t.hours().drop(*HOURLY_UNUSED)


@query("prj_label_shift", "SELECT vec_id, CAST(label AS DOUBLE) AS label FROM embeddings")
def prj_label_shift(t: Tables) -> DataFrame:
    last = f"f{VECTOR_SIZE}"
    return t.vectors().withColumn("label", C.shift_label(last)).drop(last).select("vec_id", "label")


@query(
    "prj_rename",
    "SELECT vec_id, "
    + ", ".join(
        f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS {n}"
        for i, n in enumerate(["elevation", "aspect", "slope", "vertical", "horizontal", "shade9"])
    )
    + ", label FROM embeddings",
)
def prj_rename(t: Tables) -> DataFrame:
    names = {"f0": "elevation", "f1": "aspect", "f2": "slope", "f3": "vertical", "f4": "horizontal", "f5": "shade9"}
    last = f"f{VECTOR_SIZE}"
    named = t.vectors().withColumn("label", C.shift_label(last).cast("int")).withColumnsRenamed(names)
    return named.select("vec_id", *[F.round(n, 6).alias(n) for n in names.values()], "label")


@query("flt_conjunction", USERS + "SELECT * FROM users WHERE occupation = 'BUILDING' AND gender = 'M' AND age = 25")
def flt_conjunction(t: Tables) -> DataFrame:
    return t.users().filter((F.col("occupation") == "BUILDING") & (F.col("gender") == "M") & (F.col("age") == 25))


JOINED_SQL = """
SELECT userid, age, gender, occupation, u.zipcode AS user_zipcode, z.zipcode AS zipcode, zipCodeType, city, state
FROM users u LEFT JOIN zipcodes z ON TRY_CAST(u.zipcode AS INT) = z.zipcode"""


def _joined(t: Tables) -> DataFrame:
    return R.left_join_numeric_key(t.users(), t.zipcodes(), "zipcode")


@query("join_left_df", USERS_ZIP + JOINED_SQL)
def join_left_df(t: Tables) -> DataFrame:
    return _joined(t).select(
        "userid", "age", "gender", "occupation", F.col("udf.zipcode").alias("user_zipcode"), F.col("zdf.zipcode"),
        "zipCodeType", "city", "state",
    )


def _views(t: Tables) -> None:
    t.users().alias("udf").createOrReplaceTempView("user_table")
    t.zipcodes().alias("zdf").createOrReplaceTempView("zipcode_table")


@query(
    "join_left_sql",
    USERS_ZIP + "SELECT u.*, z.city, z.state FROM users u LEFT JOIN zipcodes z ON TRY_CAST(u.zipcode AS INT) = z.zipcode",
)
def join_left_sql(t: Tables) -> DataFrame:
    _views(t)
    return t.spark.sql(
        """SELECT u.*, z.city, z.state FROM user_table u
           LEFT JOIN zipcode_table z ON try_cast(u.zipcode AS int) = z.zipcode"""
    )


@query(
    "join_left_then_filter",
    USERS_ZIP
    + """SELECT u.*, z.city, z.state FROM users u LEFT JOIN zipcodes z ON TRY_CAST(u.zipcode AS INT) = z.zipcode
         WHERE z.state = 'NATION_7'""",
)
def join_left_then_filter(t: Tables) -> DataFrame:
    _views(t)
    return t.spark.sql(
        """SELECT u.*, z.city, z.state FROM user_table u
           LEFT JOIN zipcode_table z ON try_cast(u.zipcode AS int) = z.zipcode WHERE z.state = 'NATION_7'"""
    )


@query(
    "join_mixed_type_key",
    USERS_ZIP
    + """SELECT u.zipcode AS user_zipcode, z.zipcode AS zipcode, count(*) AS counts FROM users u
         LEFT JOIN zipcodes z ON TRY_CAST(u.zipcode AS INT) = z.zipcode GROUP BY u.zipcode, z.zipcode""",
)
def join_mixed_type_key(t: Tables) -> DataFrame:
    keys = F.col("udf.zipcode").alias("user_zipcode"), F.col("zdf.zipcode").alias("zipcode")
    return _joined(t).groupBy(*keys).agg(F.count("*").alias("counts"))


@query(
    "join_group_count",
    USERS_ZIP
    + """SELECT z.state AS state, count(*) AS counts FROM users u
         LEFT JOIN zipcodes z ON TRY_CAST(u.zipcode AS INT) = z.zipcode GROUP BY z.state""",
)
def join_group_count(t: Tables) -> DataFrame:
    return R.group_count(_joined(t), "state")


@query(
    "join_lookup_broadcast",
    "SELECT c_custkey, c_name, n_nationkey AS c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def join_lookup_broadcast(t: Tables) -> DataFrame:
    people = t("customer").select("c_custkey", "c_name", "c_nationkey")
    return R.lookup(people, t("nation").select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey")


@query("agg_group_count", USERS + "SELECT occupation, count(*) AS counts FROM users GROUP BY occupation")
def agg_group_count(t: Tables) -> DataFrame:
    return R.group_count(t.users(), "occupation")


@query(
    "agg_group_count2", USERS + "SELECT gender, occupation, count(*) AS counts FROM users GROUP BY gender, occupation"
)
def agg_group_count2(t: Tables) -> DataFrame:
    return R.group_count(t.users(), "gender", "occupation").orderBy("gender", "occupation")


@query("agg_distinct1", USERS + "SELECT DISTINCT gender FROM users")
def agg_distinct1(t: Tables) -> DataFrame:
    return t.users().select("gender").distinct()


@query("agg_distinct2", USERS + "SELECT DISTINCT age, gender FROM users")
def agg_distinct2(t: Tables) -> DataFrame:
    return t.users().select("age", "gender").distinct()


@query(
    "agg_crosstab",
    USERS
    + """SELECT occupation AS occupation_gender, count(*) FILTER (gender = 'F') AS "F",
         count(*) FILTER (gender = 'M') AS "M" FROM users GROUP BY occupation""",
)
def agg_crosstab(t: Tables) -> DataFrame:
    return R.crosstab(t.users(), "occupation", "gender")


@query(
    "agg_pair_counts",
    USERS
    + """SELECT occupation, age, count(*) AS counts, CAST(sum(count(*)) OVER (PARTITION BY occupation) AS BIGINT) AS occupation_counts,
         CAST(sum(count(*)) OVER (PARTITION BY age) AS BIGINT) AS age_counts FROM users GROUP BY occupation, age""",
)
def agg_pair_counts(t: Tables) -> DataFrame:
    """A contingency table as rows, for columns with many values."""
    return R.pair_counts(t.users(), "occupation", "age")


@query(
    "agg_share",
    USERS
    + """SELECT occupation, count(*) AS counts, round(count(*) * 100.0 / (SELECT count(*) FROM users), 6) AS percent
         FROM users GROUP BY occupation""",
)
def agg_share(t: Tables) -> DataFrame:
    return R.group_share(t.users(), "occupation").withColumn("percent", F.round("percent", 6))


@query(
    "agg_extents",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, min({c}) AS lowest, max({c}) AS highest, round(avg({c}), 4) AS mean,
            round(max({c}) - min({c}), 4) AS spread FROM lineitem"""
        for c in LINE_NUMBERS
    ),
)
def agg_extents(t: Tables) -> DataFrame:
    return R.extents(t("lineitem"), *LINE_NUMBERS).withColumns(
        {"mean": F.round("mean", 4), "spread": F.round("spread", 4)}
    )


@query("txt_wordcount_space", WORDS + "," + SPACED + "SELECT word, count(*) AS counts FROM words GROUP BY word")
def txt_wordcount_space(t: Tables) -> DataFrame:
    return X.word_count(t.text_lines())


@query(
    "txt_wordcount_tokens",
    WORDS
    + """, words AS (SELECT unnest(regexp_split_to_array(value, '[ \\t\\n\\r\\f]+')) AS word FROM lines_)
         SELECT word, count(*) AS counts FROM words WHERE word <> '' GROUP BY word""",
)
def txt_wordcount_tokens(t: Tables) -> DataFrame:
    return X.word_count(t.text_lines(), X.token_words)


@query("txt_vocabulary_size", WORDS + "," + SPACED + "SELECT count(DISTINCT word) AS words FROM words")
def txt_vocabulary_size(t: Tables) -> DataFrame:
    return X.vocabulary_size(t.text_lines())


@query("srt_asc_top5", USERS + "SELECT userid, occupation, gender, age FROM users ORDER BY age, userid LIMIT 5")
def srt_asc_top5(t: Tables) -> DataFrame:
    return t.users().select("userid", "occupation", "gender", "age").orderBy("age", "userid").limit(5)


@query("srt_desc_top5", USERS + "SELECT userid, occupation, gender, age FROM users ORDER BY age DESC, userid LIMIT 5")
def srt_desc_top5(t: Tables) -> DataFrame:
    return t.users().select("userid", "occupation", "gender", "age").orderBy(F.desc("age"), "userid").limit(5)


@query(
    "srt_mixed",
    USERS + "SELECT userid, occupation, age, gender, zipcode FROM users ORDER BY age DESC, gender, userid LIMIT 5",
)
def srt_mixed(t: Tables) -> DataFrame:
    chosen = t.users().select("userid", "occupation", "age", "gender", "zipcode")
    return chosen.orderBy(["age", "gender", "userid"], ascending=[0, 1, 1]).limit(5)


@query("srt_limit", USERS + "SELECT * FROM users ORDER BY userid LIMIT 5")
def srt_limit(t: Tables) -> DataFrame:
    return t.users().orderBy("userid").limit(5)


@query(
    "scl_clamp_nonnegative",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def scl_clamp_nonnegative(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", C.clamp_nonnegative("c_acctbal").alias("c_acctbal"))


def _case(column: str, texts: dict[int, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in texts.items()) + " END"


@query(
    "scl_code_to_text",
    HOURS
    + f"""SELECT instant, {_case('season', C.SEASONS)} AS season, {_case('holiday', C.HOLIDAYS)} AS holiday,
          {_case('weekday', C.WEEKDAYS)} AS weekday, {_case('workingday', C.WORKING_DAYS)} AS workingday,
          {_case('weathersit', C.WEATHER)} AS weathersit FROM hours""",
)
def scl_code_to_text(t: Tables) -> DataFrame:
    texts = {
        "season": C.SEASONS, "holiday": C.HOLIDAYS, "weekday": C.WEEKDAYS,
        "workingday": C.WORKING_DAYS, "weathersit": C.WEATHER,
    }
    return t.hours().select("instant", *[C.code_to_text(c, m).alias(c) for c, m in texts.items()])


@query(
    "scl_denormalise",
    HOURS
    + "SELECT instant, "
    + ", ".join(f"{c} * {m} AS {c}" for c, m in C.READING_MAXIMA.items())
    + " FROM hours",
)
def scl_denormalise(t: Tables) -> DataFrame:
    return t.hours().select(
        "instant", *[C.denormalise(c, m).alias(c) for c, m in C.READING_MAXIMA.items()]
    )
