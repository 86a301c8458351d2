"""Splits by hash, position and user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators import splits as S
from tallyframe.plans.registry import query
from tallyframe.plans.tables import RATINGS_SQL, Tables
from tallyframe.session import staged


def bucket_sql(key: str, buckets: int = 100) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {buckets})"


@query(
    "spl_hash_70_30",
    f"""SELECT event_id, user_id, CASE WHEN {bucket_sql('event_id')} < 70 THEN 'train' ELSE 'test' END AS part
        FROM events""",
)
def spl_hash_70_30(t: Tables) -> DataFrame:
    return S.hash_split(t("events").select("event_id", "user_id"), ["event_id"], {"train": 70, "test": 30})


@query(
    "spl_hash_80_10_10",
    f"""SELECT event_id, user_id, CASE WHEN {bucket_sql('event_id')} < 80 THEN 'train'
        WHEN {bucket_sql('event_id')} < 90 THEN 'validation' ELSE 'test' END AS part FROM events""",
)
def spl_hash_80_10_10(t: Tables) -> DataFrame:
    parts = {"train": 80, "validation": 10, "test": 10}
    return S.hash_split(t("events").select("event_id", "user_id"), ["event_id"], parts)


@query(
    "spl_exact_80_20",
    """SELECT event_id, user_id, CASE WHEN row_number() OVER (ORDER BY substr(md5(CAST(event_id AS VARCHAR)), 1, 15)) <= count(*) OVER () * 80 // 100
       THEN 'train' ELSE 'validation' END AS part FROM events""",
)
def spl_exact_80_20(t: Tables) -> DataFrame:
    return S.exact_split(t("events").select("event_id", "user_id"), ["event_id"], {"train": 80, "validation": 20})


FOLDED_SQL = f"""
WITH ratings AS ({RATINGS_SQL}),
placed AS (SELECT *, row_number() OVER (ORDER BY first_order, "user", item) AS rn FROM ratings),
sized AS (SELECT CAST(ceil(count(*) / 5.0) AS BIGINT) AS size FROM ratings),
folded AS (SELECT "user", item, rating, CAST((rn - 1) // size + 1 AS INT) AS fold FROM placed, sized) """


def _folded(t: Tables) -> DataFrame:
    ratings = staged(t.ratings(), "ratings")
    return S.positional_folds(ratings, ["first_order", "user", "item"], folds=5).drop("first_order")


@query("spl_kfold_test", FOLDED_SQL + "SELECT * FROM folded")
def spl_kfold_test(t: Tables) -> DataFrame:
    return _folded(t)


@query(
    "spl_kfold_base",
    FOLDED_SQL
    + """SELECT t.fold, count(*) AS counts, CAST(sum(item) AS BIGINT) AS items, sum(rating) AS ratings
         FROM folded f JOIN (SELECT unnest(range(1, 6)) AS fold) t ON f.fold <> t.fold GROUP BY t.fold""",
)
def spl_kfold_base(t: Tables) -> DataFrame:
    others = F.array_except(F.sequence(F.lit(1), F.lit(5)), F.array("fold"))
    bases = _folded(t).withColumn("fold", F.explode(others))
    return bases.groupBy(F.col("fold").cast("long").alias("fold")).agg(
        F.count("*").alias("counts"),
        F.sum("item").alias("items"),
        F.sum(F.col("rating").cast("double")).alias("ratings"),
    )


def _left_out_sql(start: int, stop: int) -> str:
    return f"""SELECT event_id, user_id,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) BETWEEN {start} AND {stop} AS held_out FROM events"""


def _left_out(t: Tables, start: int, stop: int, max_test: int = 0) -> DataFrame:
    events = t("events").select("event_id", "user_id", "ts")
    return S.leave_n_out(events, "user_id", ["ts", "event_id"], start, stop, max_test).drop("ts")


@query("win_leave_n_out_a", _left_out_sql(1, 10))
def win_leave_n_out_a(t: Tables) -> DataFrame:
    return _left_out(t, 1, 10)


@query("win_leave_n_out_b", _left_out_sql(11, 20))
def win_leave_n_out_b(t: Tables) -> DataFrame:
    return _left_out(t, 11, 20)


@query(
    "win_leave_n_out_capped",
    """WITH ranked AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
                       FROM events),
       placed AS (SELECT *, sum(CASE WHEN rn <= 10 THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id) AS place FROM ranked)
       SELECT event_id, user_id, rn <= 10 AND place <= 1000 AS held_out FROM placed""",
)
def win_leave_n_out_capped(t: Tables) -> DataFrame:
    return _left_out(t, 1, 10, max_test=1000)
