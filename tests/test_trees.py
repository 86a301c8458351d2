"""Node tables and rules: right trees pass, tampered ones are found."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyframe.operators import features as V
from tallyframe.operators import models as M
from tallyframe.operators import trees as N

FAULTS = ["wrong_rows", "wrong_gain", "beaten", "wrong_value"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(300):
        a, b, cat = rng.random(), rng.randrange(6), rng.choice("pqr")
        y = 3.0 * (a > 0.4) + b * b + {"p": 0, "q": 5, "r": 1}[cat] + rng.gauss(0, 0.3)
        data.append((i, a, float(b), cat, y, float(y > 12)))
    return spark.createDataFrame(data, "id int, a double, b double, cat string, y double, label double").persist()


def fitted(rows, kind):
    if kind == "variance":
        stages = V.indexed_stages(["a", "b"])
        model = M.fit(stages, M.tree_regressor("y", maxDepth=4), rows)
    else:
        model = M.fit(V.category_stages("cat", ["a", "b"]), M.tree_classifier(kind, 4, 10), rows)
    nodes = N.node_table(model.stages[-1], rows.sparkSession)
    return PipelineModel(model.stages[:-1]).transform(rows), nodes, "y" if kind == "variance" else "label", model


def faults(prepared, nodes, label, kind, **more):
    found = N.check_nodes(prepared, nodes, [1.0], kind, label, **more)
    return {f for f in FAULTS if found.filter(F.col(f)).count()}


@pytest.mark.parametrize("kind", ["gini", "entropy", "variance"])
def test_fitted_trees_hold(rows, kind):
    prepared, nodes, label, _ = fitted(rows, kind)
    assert nodes.count() > 7
    assert faults(prepared, nodes, label, kind) == set()


@pytest.mark.parametrize("kind", ["gini", "variance"])
def test_tampered_trees_are_found(rows, kind):
    prepared, nodes, label, _ = fitted(rows, kind)
    spark = rows.sparkSession

    def changed(change):
        held = [change(r.asDict()) for r in nodes.collect()]
        return spark.createDataFrame([tuple(r[c] for c in nodes.columns) for r in held], nodes.schema)

    leaf = changed(lambda r: r | {"prediction": 1.0 - r["prediction"]} if r["feature"] < 0 else r)
    assert faults(prepared, leaf, label, kind) == {"wrong_value"}
    gain = changed(lambda r: r | {"gain": r["gain"] * 0.9})
    assert faults(prepared, gain, label, kind) == {"wrong_gain", "beaten"}
    swapped = changed(lambda r: r | {"left": r["right"], "right": r["left"]} if r["node"] == 0 else r)
    assert "wrong_rows" in faults(prepared, swapped, label, kind)


def test_a_worse_split_is_beaten(rows):
    """A tree that was not grown greedily: the root cuts at a threshold that is better further down."""
    spark = rows.sparkSession
    prepared = V.numeric_stages(["a", "b"])[0].transform(rows)

    def node(n, cut=None, left=-1, right=-1):
        return n, (0.0, 0.0, 0, 0.0, left, right, 1 if cut else -1, [cut] if cut else [], -1)

    shape = [node(0, 0.5, 1, 2), node(1), node(2, 3.5, 3, 4), node(3), node(4)]
    schema = "tree int, node int, prediction double, impurity double, rows long, gain double, left int, right int, feature int, split array<double>, categories int"
    nodes = spark.createDataFrame([(0, n, *rest) for n, rest in shape], schema)
    found = {r.node: r for r in N.check_nodes(prepared, nodes, [1.0], "variance", "y").collect()}
    assert found[0].beaten and found[0].wrong_gain


def test_boosted_trees_follow_their_residuals(rows):
    model = M.fit(V.numeric_stages(["a", "b"]), M.boosted_regressor("y", maxDepth=3, maxIter=4), rows)
    boosted = model.stages[-1]
    nodes = N.node_table(boosted, rows.sparkSession)
    prepared = PipelineModel(model.stages[:-1]).transform(rows)

    def wrong(weights, **more):
        found = N.check_nodes(prepared, nodes, weights, "variance", "y", **more)
        return {r.tree for r in found.filter(" or ".join(FAULTS)).collect()}

    assert wrong(boosted.treeWeights, boosted=True) == set()
    assert wrong([1.0, 0.2, 0.1, 0.1], boosted=True) == {2, 3}
    assert wrong(boosted.treeWeights) == {1, 2, 3}
    scored = N.score_by_nodes(model.transform(rows), N.trees_of(nodes), boosted.treeWeights)
    assert scored.filter(F.abs(F.col("by_nodes") - F.col("prediction")) > 1e-9).count() == 0


@pytest.mark.parametrize("kind", ["gini", "variance"])
def test_rules_give_the_predictions(rows, kind):
    prepared, nodes, _, model = fitted(rows, kind)
    rules = N.rules_table(nodes)
    assert rules.select("rule").distinct().count() == nodes.filter("feature < 0").count()
    assert {r.side for r in rules.select("side").distinct().collect()} >= {"<=", ">"}
    scored = N.by_rules(model.transform(rows), rules)
    assert scored.filter("by_rules <> prediction or by_rules is null").count() == 0


def test_tree_without_split(spark):
    rows = spark.createDataFrame([(1.0, 2.0)] * 3, "a double, y double")
    model = M.fit(V.numeric_stages(["a"]), M.tree_regressor("y"), rows)
    nodes = N.node_table(model.stages[-1], spark)
    prepared = PipelineModel(model.stages[:-1]).transform(rows)
    assert faults(prepared, nodes, "y", "variance") == set()
    assert [r.by_rules for r in N.by_rules(prepared, N.rules_table(nodes)).collect()] == [2.0] * 3


def test_unseen_categories_go_where_the_model_sends_them(spark, rows):
    """Categories that were not there in training, as one index more than the known ones."""
    rng = random.Random(5)
    data = [(float(c), float((c * 7) % 11 + rng.random())) for c in range(9) for _ in range(6)]
    train = spark.createDataFrame(data, "c double, y double")
    model = M.fit(V.indexed_stages(["c"], unseen="keep"), M.tree_regressor("y", maxDepth=5), train)
    test = spark.createDataFrame([(float(c), 0.0) for c in range(-2, 13)], "c double, y double")
    nodes = N.node_table(model.stages[-1], spark)
    scored = N.by_rules(N.score_by_nodes(model.transform(test), N.trees_of(nodes), [1.0]), N.rules_table(nodes))
    for r in scored.collect():
        assert r.by_nodes == pytest.approx(r.prediction) and r.by_rules == pytest.approx(r.prediction)
