"""Checkable rows of iteratively trained models: how many rows each gave and how many of them hold what they must."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators import features as V
from tallyframe.operators import models as M
from tallyframe.operators import recommend as R
from tallyframe.operators import trees as N
from tallyframe.plans import clustering, learning, recommending
from tallyframe.plans.registry import query
from tallyframe.plans.relational import HOURS, PAGES
from tallyframe.plans.splits import bucket_sql
from tallyframe.plans.tables import HOUR_FEATURES, LINE_NUMBERS, RATINGS_SQL, Tables
from tallyframe.session import fresh_path
from tallyframe.sources.sinks import save_model_once

NODE_FAULTS = ["wrong_rows", "wrong_gain", "beaten", "wrong_value"]


def _counted(name: str, df: DataFrame, sound: Column) -> DataFrame:
    return df.agg(F.lit(name).alias("name"), F.count("*").alias("counts"), F.count_if(sound).alias("sound"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _nodes_sql(names: list[str], train: str, test: str) -> str:
    none = ", ".join(f"CAST(0 AS BIGINT) AS {f}" for f in [*NODE_FAULTS, "misrouted"])
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, true AS grown, {none}, (SELECT count(*) FROM {train}) AS train_rows, (SELECT count(*) FROM {test}) AS test_rows"
        for n in names
    )


def _nodes_checked(
    name: str, stages: list, estimator, kind: str, parts: tuple[DataFrame, DataFrame], label: str = "label", boosted: bool = False
) -> DataFrame:
    """Train, then count the nodes that the training rows contradict, and the test rows whose way through the nodes ends elsewhere than the model says."""
    train, test = parts
    fitted = M.fit(stages, estimator, train)
    model = fitted.stages[-1]
    nodes = N.node_table(model, train.sparkSession)
    weights = model.treeWeights if boosted else [1.0]
    prepared = PipelineModel(fitted.stages[:-1]).transform(train)
    found = N.check_nodes(prepared, nodes, weights, kind, label, boosted=boosted)
    scored = N.score_by_nodes(fitted.transform(test), N.trees_of(nodes), weights)
    off = F.abs(F.col("by_nodes") - F.col("prediction")) > 1e-9 * (1 + F.abs("prediction"))
    faults = found.agg(F.max("inner").alias("grown"), *[F.count_if(F.col(f)).alias(f) for f in NODE_FAULTS]).first()
    routed = scored.agg(F.count_if(off).alias("misrouted"), F.count("*").alias("test_rows")).first()
    row = (name, *faults, routed["misrouted"], train.count(), routed["test_rows"])
    schema = "name string, grown boolean, " + ", ".join(f"{f} long" for f in [*NODE_FAULTS, "misrouted", "train_rows", "test_rows"])
    return train.sparkSession.createDataFrame([row], schema)


@query(
    "chk_page_models",
    PAGES + _nodes_sql(["cls_tree_binary", "cls_tree_binary_entropy"], f"pages_ WHERE {bucket_sql('url')} < 70", f"pages_ WHERE {bucket_sql('url')} >= 70"),
)
def chk_page_models(t: Tables) -> DataFrame:
    """The trees of ``cls_tree_binary`` and ``cls_tree_binary_entropy``, node by node."""
    parts = learning.two_parts(learning.clean_pages(t), "url")
    settings = {"cls_tree_binary": ("gini", 10, 14), "cls_tree_binary_entropy": ("entropy", 5, 5)}
    return _union(
        [_nodes_checked(n, learning.page_stages(), M.tree_classifier(*s), s[0], parts) for n, s in settings.items()]
    )


@query(
    "chk_class_models",
    _nodes_sql(["cls_tree_multi", "cls_tree_multi_entropy"], f"embeddings WHERE {bucket_sql('vec_id')} < 70", f"embeddings WHERE {bucket_sql('vec_id')} >= 70"),
)
def chk_class_models(t: Tables) -> DataFrame:
    """The trees of ``cls_tree_multi`` and ``cls_tree_multi_entropy``, node by node."""
    parts = learning.two_parts(learning.classes(t), "vec_id")
    stages = V.numeric_stages(learning.VECTOR_FEATURES)
    settings = {"cls_tree_multi": ("gini", 5, 20), "cls_tree_multi_entropy": ("entropy", 15, 50)}
    return _union([_nodes_checked(n, stages, M.tree_classifier(*s), s[0], parts) for n, s in settings.items()])


@query(
    "chk_hour_models",
    HOURS + _nodes_sql(["reg_tree", "reg_tree_variance", "reg_gbt"], f"hours WHERE {bucket_sql('instant')} < 70", f"hours WHERE {bucket_sql('instant')} >= 70"),
)
def chk_hour_models(t: Tables) -> DataFrame:
    """The trees of ``reg_tree``, ``reg_tree_variance`` and, each on what the trees before it leave, ``reg_gbt``."""
    parts = learning.two_parts(learning.hourly(t), "instant")
    indexed = V.indexed_stages(HOUR_FEATURES, unseen="keep")
    boosted = M.boosted_regressor(maxDepth=5, maxBins=25, maxIter=10)
    return _union(
        [
            _nodes_checked("reg_tree", indexed, M.tree_regressor(), "variance", parts, "cnt"),
            _nodes_checked(
                "reg_tree_variance", V.numeric_stages(HOUR_FEATURES), M.tree_regressor(maxDepth=10, maxBins=100), "variance", parts, "cnt"
            ),
            _nodes_checked("reg_gbt", indexed, boosted, "variance", parts, "cnt", boosted=True),
        ]
    )


def _page_rules(t: Tables):
    stages = learning.page_stages()
    return M.fit(stages, M.tree_classifier("entropy", 5, 5), learning.two_parts(learning.clean_pages(t), "url")[0])


@query("prd_rules")
def prd_rules(t: Tables) -> DataFrame:
    """The tree of ``cls_tree_binary_entropy`` as rules, one row per condition."""
    return N.rules_table(N.node_table(_page_rules(t).stages[-1], t.spark))


@query(
    "prd_by_rules",
    PAGES + "SELECT count(*) AS counts, count(*) AS one_rule, count(*) AS as_model FROM pages_",
)
def prd_by_rules(t: Tables) -> DataFrame:
    """Every labelled page meets exactly one rule, and its value is the model's prediction."""
    fitted = _page_rules(t)
    rules = N.rules_table(N.node_table(fitted.stages[-1], t.spark))
    scored = N.by_rules(fitted.transform(learning.clean_pages(t)), rules)
    met = rules.groupBy("rule").agg(F.sort_array(F.collect_list(F.struct("place", "feature", "side", "split"))).alias("way"))
    values = scored.select("url", "by_rules", "prediction", vector_to_array("features").alias("x"))

    def holds(c: Column) -> Column:
        inside = F.array_contains(c["split"], F.element_at(F.col("x"), c["feature"] + 1))
        below = F.element_at(F.col("x"), c["feature"] + 1) <= F.element_at(c["split"], 1)
        return F.when(c["side"] == "<=", below).when(c["side"] == ">", ~below).when(c["side"] == "in", inside).otherwise(~inside)

    # rules travel as one array, there are at most as many as leaves
    every = met.agg(F.collect_list("way").alias("ways")).first()["ways"]
    ways = F.from_json(F.lit(json.dumps([[c.asDict() for c in w] for w in every])), "array<array<struct<place:int,feature:int,side:string,split:array<double>>>>")
    hits = F.size(F.filter(ways, lambda way: F.forall(way, holds)))
    return values.agg(
        F.count("*").alias("counts"),
        F.count_if(hits == 1).alias("one_rule"),
        F.count_if(F.col("by_rules") == F.col("prediction")).alias("as_model"),
    )


@query(
    "chk_recommended",
    f"""WITH ratings AS ({RATINGS_SQL}), n AS (SELECT least(10, count(DISTINCT item)) AS items, least(10, count(DISTINCT "user")) AS users FROM ratings)
    SELECT 'items' AS name, items AS counts, items AS sound FROM n UNION ALL
    SELECT 'users' AS name, users AS counts, users AS sound FROM n UNION ALL
    SELECT 'loaded' AS name, items AS counts, items AS sound FROM n""",
)
def chk_recommended(t: Tables) -> DataFrame:
    """Ranks are 1 to k by falling score, the score is the factors' product, the title the item's; a saved model gives the same."""
    ratings, path = recommending._ratings(t), fresh_path(t.spark, "factors")
    model = R.train_factors(ratings)
    save_model_once(model, path)
    user, item = recommending._busiest(ratings, "user"), recommending._busiest(ratings, "item")
    names = t.titles().withColumnRenamed("title", "name_")
    user_side = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("u"))
    item_side = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("i"))
    product = F.aggregate(F.zip_with("u", "i", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)

    def sound(asked: str) -> Column:
        by_rank = Window.partitionBy(asked).orderBy("rank")
        falling = F.coalesce(F.lag("score").over(by_rank) >= F.col("score"), F.lit(True))
        return falling & (F.row_number().over(by_rank) == F.col("rank"))

    def checked(name: str, found: DataFrame, asked: str) -> DataFrame:
        full = found.withColumn("ordered", sound(asked)).join(names, "item", "left").join(user_side, "user").join(item_side, "item")
        scored = F.abs(product - F.col("score")) < 1e-4 * (1 + F.abs("score"))
        return _counted(name, full, F.col("ordered") & scored & F.col("title").eqNullSafe(F.col("name_")))

    items = R.items_for_users(model, user, t.titles())
    loaded = R.items_for_users(R.load_model(path), user, t.titles())
    same = loaded.join(items.withColumnRenamed("score", "before"), ["user", "rank", "item", "title"], "left")
    return _union(
        [
            checked("items", items, "user"),
            checked("users", R.users_for_items(model, item, t.titles()), "item"),
            _counted("loaded", same, F.col("score") == F.col("before")),
        ]
    )


@query("chk_clusters", "SELECT x, y, n, n AS counts, 3 AS clusters FROM (SELECT count(*) AS n FROM lineitem), (VALUES "
       + ", ".join(f"('{a}', '{b}')" for a, b in clustering.K.column_pairs(LINE_NUMBERS)) + ") AS p(x, y)")
def chk_clusters(t: Tables) -> DataFrame:
    """Per column pair the cluster sizes add up to the table."""
    sizes = clustering.clu_report(t).groupBy("x", "y").agg(F.sum("counts").alias("counts"), F.count("*").cast("int").alias("clusters"))
    return sizes.crossJoin(F.broadcast(t("lineitem").agg(F.count("*").alias("n")))).select("x", "y", "n", "counts", "clusters")
