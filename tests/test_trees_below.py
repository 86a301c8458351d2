"""Node checks hold sums of a bounded number of nodes; what is below them is summed up part by part, with the same findings."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyframe.operators import features as V
from tallyframe.operators import models as M
from tallyframe.operators import trees as N

FAULTS = ["wrong_rows", "wrong_gain", "beaten", "wrong_value"]


@pytest.mark.parametrize("kind", ["entropy", "boosted"])
def test_few_held_nodes_find_the_same(spark, monkeypatch, kind):
    rng = random.Random(4)
    data = [(rng.random(), rng.random(), rng.choice("pqrs"), float(rng.randrange(3)), rng.gauss(0, 3), float(rng.randrange(4))) for _ in range(400)]
    rows = spark.createDataFrame(data, "a double, b double, cat string, label double, y double, d double")
    stages = V.category_stages("cat", ["a", "b"]) if kind == "entropy" else V.indexed_stages(["a", "b", "d"])
    estimator = M.tree_classifier("entropy", 8, 16) if kind == "entropy" else M.boosted_regressor("y", maxDepth=4, maxIter=3)
    model = M.fit(stages, estimator, rows)
    prepared, nodes = PipelineModel(model.stages[:-1]).transform(rows), N.node_table(model.stages[-1], spark)
    wrong = nodes.withColumn("gain", F.when(F.col("node") % 5 == 3, F.col("gain") * 0.8).otherwise(F.col("gain")))
    more = ("entropy", "label") if kind == "entropy" else ("variance", "y")
    weights = [1.0] if kind == "entropy" else model.stages[-1].treeWeights

    def found(nodes):
        checked = N.check_nodes(prepared, nodes, weights, *more, boosted=kind == "boosted")
        return sorted(checked.select("tree", "node", "inner", *FAULTS).collect())

    whole = [found(nodes), found(wrong)]
    assert not any(r[f] for r in whole[0] for f in FAULTS) and any(r["wrong_gain"] for r in whole[1])
    monkeypatch.setattr(N, "HELD_SUMS", 1)
    assert [found(nodes), found(wrong)] == whole
    trees = N.trees_of(nodes)
    held = N._held_nodes(trees, 3)
    assert sum(int((h >= 0).sum()) for h in held) == 3
    for tree, places in zip(trees, held):
        below = [n for side in (tree.left, tree.right) for n in side[(places < 0) & (tree.feature >= 0)]]
        assert all(places[n] < 0 for n in below)
