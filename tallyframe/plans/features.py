"""Feature preparation and metric queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import clean_numeric
from tallyframe.operators import evaluate as E
from tallyframe.operators import features as V
from tallyframe.plans.registry import query
from tallyframe.plans.relational import HOURS, PAGES
from tallyframe.plans.tables import HOUR_FEATURES, LINE_NUMBERS, PAGE_NUMBERS, SCORED_SQL, Tables

INDEXED = (
    PAGES
    + """, categories AS (SELECT alchemy_category,
           CAST(row_number() OVER (ORDER BY count(*) DESC, alchemy_category) - 1 AS INT) AS category_index,
           count(*) AS counts FROM pages_ GROUP BY alchemy_category) """
)


def clean_pages(t: Tables) -> DataFrame:
    raw = t.raw_pages()
    return clean_numeric(raw, raw.columns[2:])


def labelled_or_not(t: Tables) -> DataFrame:
    """All pages; the label is null where there is none."""
    return clean_numeric(t.raw_pages(labelled=False), PAGE_NUMBERS).withColumn("label", F.col("label").cast("double"))


@query("ftr_string_index", INDEXED + "SELECT * FROM categories")
def ftr_string_index(t: Tables) -> DataFrame:
    return V.category_index(clean_pages(t).select("alchemy_category"), "alchemy_category")


@query(
    "ftr_one_hot",
    INDEXED
    + "SELECT url, "
    + ", ".join(f"CAST(category_index = {i} AS DOUBLE) AS is{i}" for i in range(4))
    + " FROM pages_ JOIN categories USING (alchemy_category)",
)
def ftr_one_hot(t: Tables) -> DataFrame:
    pages = clean_pages(t).select("url", "alchemy_category")
    stages = [V.category_indexer("alchemy_category"), V.category_encoder("alchemy_category")]
    fitted = Pipeline(stages=stages).fit(pages)
    coded = fitted.transform(pages).select("url", "alchemy_category_vec")
    return V.unpack(coded, "alchemy_category_vec", [f"is{i}" for i in range(V.category_size(fitted))])


@query(
    "ftr_assemble",
    INDEXED
    + "SELECT url, label, "
    + ", ".join(f"CAST(category_index = {i} AS DOUBLE) AS x{i}" for i in range(4))
    + ", "
    + ", ".join(f"{c} AS x{i + 4}" for i, c in enumerate(PAGE_NUMBERS))
    + " FROM pages_ JOIN categories USING (alchemy_category)",
)
def ftr_assemble(t: Tables) -> DataFrame:
    pages = clean_pages(t)
    stages = V.category_stages("alchemy_category", PAGE_NUMBERS)
    fitted = Pipeline(stages=stages).fit(pages)
    built = fitted.transform(pages).select("url", "label", "features")
    return V.unpack(built, "features", [f"x{i}" for i in range(V.category_size(fitted) + len(PAGE_NUMBERS))])


PLACED = """SELECT {keys}, unnest(range(len(f)))::INT AS place, unnest(f) AS value
    FROM (SELECT {keys}, list_concat(list_transform(range((SELECT count(*) FROM categories)), lambda i: (i = category_index)::INT::DOUBLE), {numbers}) AS f
          FROM pages_ JOIN categories USING (alchemy_category))"""


@query("ftr_one_hot_placed", INDEXED + PLACED.format(keys="url", numbers="[]::DOUBLE[]"))
def ftr_one_hot_placed(t: Tables) -> DataFrame:
    """The one-hot vectors as rows, so that the number of categories is free."""
    pages = clean_pages(t).select("url", "alchemy_category")
    stages = [V.category_indexer("alchemy_category"), V.category_encoder("alchemy_category")]
    return V.placed(Pipeline(stages=stages).fit(pages).transform(pages), "alchemy_category_vec", "url")


@query("ftr_assemble_placed", INDEXED + PLACED.format(keys="url, label", numbers=f"[{', '.join(PAGE_NUMBERS)}]"))
def ftr_assemble_placed(t: Tables) -> DataFrame:
    pages = clean_pages(t)
    fitted = Pipeline(stages=V.category_stages("alchemy_category", PAGE_NUMBERS)).fit(pages)
    return V.placed(fitted.transform(pages), "features", "url", "label")


@query(
    "ftr_hourly_features",
    HOURS + "SELECT instant, " + ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(HOUR_FEATURES)) + ", cnt FROM hours",
)
def ftr_hourly_features(t: Tables) -> DataFrame:
    hours = t.hours().select("instant", *HOUR_FEATURES, "cnt")
    built = V.numeric_stages(HOUR_FEATURES)[0].transform(hours).select("instant", "cnt", "features")
    return V.unpack(built, "features", [f"x{i}" for i in range(len(HOUR_FEATURES))])


@query(
    "ftr_vector_index",
    HOURS
    + "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS categories FROM hours" for c in HOUR_FEATURES)
    + ") WHERE categories <= 24",
)
def ftr_vector_index(t: Tables) -> DataFrame:
    hours = t.hours().select(*HOUR_FEATURES)
    indexer = Pipeline(stages=V.indexed_stages(HOUR_FEATURES)).fit(hours).stages[-1]
    rows = [(HOUR_FEATURES[j], len(values)) for j, values in indexer.categoryMaps.items()]
    return t.spark.createDataFrame(rows, "feature string, categories long")


def _scaled_sql(expression: str) -> str:
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LINE_NUMBERS)
    values = ", ".join(f"round({expression.format(c=c)}, 6) + 0.0 AS {c}" for c in LINE_NUMBERS)
    return f"WITH m AS (SELECT {moments} FROM lineitem) SELECT l_orderkey, l_linenumber, {values} FROM lineitem, m"


def _scaled(t: Tables, with_mean: bool) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    stages = [*V.numeric_stages(LINE_NUMBERS), V.scaler(with_mean)]
    fitted = Pipeline(stages=stages).fit(lines).transform(lines)
    scaled = V.unpack(fitted.drop("features"), "scaled", LINE_NUMBERS)
    return scaled.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in LINE_NUMBERS})


@query("ftr_standardise", _scaled_sql("({c} - m_{c}) / s_{c}"))
def ftr_standardise(t: Tables) -> DataFrame:
    return _scaled(t, True)


@query("ftr_scale_std_only", _scaled_sql("{c} / s_{c}"))
def ftr_scale_std_only(t: Tables) -> DataFrame:
    return _scaled(t, False)


SCORED = f"WITH scored AS ({SCORED_SQL}) "


@query(
    "evl_auc_scores",
    SCORED
    + """, g AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
                 FROM scored GROUP BY score),
         r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM g)
         SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS auc FROM r""",
)
def evl_auc_scores(t: Tables) -> DataFrame:
    return E.auc_of_scores(t.scored()).select(F.round("auc", 9).alias("auc"))


@query(
    "evl_auc_hard",
    SCORED
    + """SELECT round((avg(CASE WHEN label = 1 THEN CASE WHEN prediction = 1 THEN 1.0 ELSE 0.0 END END)
                     + avg(CASE WHEN label = 0 THEN CASE WHEN prediction = 0 THEN 1.0 ELSE 0.0 END END)) / 2, 9) AS auc
         FROM scored""",
)
def evl_auc_hard(t: Tables) -> DataFrame:
    return E.auc_of_classes(t.scored()).select(F.round("auc", 9).alias("auc"))


@query(
    "evl_accuracy",
    SCORED + "SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored",
)
def evl_accuracy(t: Tables) -> DataFrame:
    return E.accuracy(t.scored()).select(F.round("accuracy", 9).alias("accuracy"))


def _priced(t: Tables) -> DataFrame:
    """Line prices as labels, discounted prices as their predictions."""
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("label"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prediction"),
    )


@query("evl_rmse", "SELECT round(sqrt(avg(pow(l_extendedprice * (1 - l_discount) - l_extendedprice, 2))), 4) AS rmse FROM lineitem")
def evl_rmse(t: Tables) -> DataFrame:
    return E.rmse(_priced(t)).select(F.round("rmse", 4).alias("rmse"))


@query(
    "evl_residuals",
    """SELECT l_orderkey, l_linenumber, round(abs(l_extendedprice - trunc(l_extendedprice * (1 - l_discount))), 4) AS error,
              l_extendedprice = trunc(l_extendedprice * (1 - l_discount)) AS hit FROM lineitem""",
)
def evl_residuals(t: Tables) -> DataFrame:
    found = E.residuals(_priced(t))
    return found.select("l_orderkey", "l_linenumber", F.round("error", 4).alias("error"), "hit")
