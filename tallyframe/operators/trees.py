"""Fitted trees as tables: nodes, rules, and whether every split is the best one for the rows that reach it.

A model has a bounded number of nodes, so its nodes may be held by the driver and by every task, as
Spark itself does when it predicts. Rows are routed through them in the tasks. The nodes with most rows, as many as
``HELD_SUMS`` allows, have their histograms added up in the tasks; what leaves a task is one row per such node, feature and bin.
A row that goes on below them is sent once, as its bins, to the part of the tree it enters, where node after node is summed up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import discard, fresh_path, staged

#: Sums that a task holds for the nodes with most rows.
HELD_SUMS = 4_000_000

RULES = "tree int, rule int, place int, feature int, side string, split array<double>, value double"


def node_table(model, spark) -> DataFrame:
    """tree, node, prediction, impurity, rows, gain, left, right, feature, split, categories; a leaf has no feature (-1)."""
    path = fresh_path(spark, "trees")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if "nodeData" in stored.columns:
        stored = stored.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        stored = stored.withColumn("tree", F.lit(0))
    split = F.col("split")
    return stored.select(
        "tree",
        F.col("id").alias("node"),
        "prediction",
        "impurity",
        F.col("rawCount").alias("rows"),
        "gain",
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        split["featureIndex"].alias("feature"),
        split["leftCategoriesOrThreshold"].alias("split"),
        split["numCategories"].alias("categories"),
        F.col("impurityStats").alias("stats"),
    )


def _unseen_left(node) -> bool:
    """Where a category goes that was not there in training: with the larger half of the known ones, left if more than half are."""
    return len(node["split"]) > node["categories"] // 2


@dataclass(frozen=True)
class Tree:
    """The nodes of one tree as arrays by node number; a leaf has feature -1. ``share``: of class 1, if classes are told apart."""

    feature: np.ndarray
    threshold: np.ndarray
    goes_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    reached: np.ndarray
    share: np.ndarray

    def paths(self, x: np.ndarray, start: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, nodes) of each level that rows reach, from node ``start`` down."""
        rows, nodes = np.arange(len(x)), np.full(len(x), start, np.int64)
        while len(rows):
            yield rows, nodes
            inner = self.feature[nodes] >= 0
            rows, nodes = rows[inner], nodes[inner]
            value = x[rows, self.feature[nodes]]
            # the last place stands for every category that was not there in training
            chosen = self.goes_left[nodes, np.clip(value, 0, self.goes_left.shape[1] - 1).astype(np.int64)]
            by_category = np.isnan(self.threshold[nodes])
            nodes = np.where(np.where(by_category, chosen, value <= self.threshold[nodes]), self.left[nodes], self.right[nodes])

    def cut(self, depth: int) -> Tree:
        """The tree without what is more than ``depth`` splits below its root: what training with this depth gives, if all features and rows count at every node."""
        feature, level = self.feature.copy(), np.zeros(1, np.int64)
        for _ in range(depth):
            level = level[feature[level] >= 0]
            level = np.concatenate([self.left[level], self.right[level]])
        feature[level] = -1
        return replace(self, feature=feature)

    def merged(self) -> Tree:
        """Without splits below which all leaves predict the same, as Spark returns its trees."""
        feature, levels = self.feature.copy(), [np.zeros(1, np.int64)]
        while len(levels[-1]):
            inner = levels[-1][feature[levels[-1]] >= 0]
            levels.append(np.concatenate([self.left[inner], self.right[inner]]))
        for level in reversed(levels):
            inner = level[feature[level] >= 0]
            left, right = self.left[inner], self.right[inner]
            feature[inner[(feature[left] < 0) & (feature[right] < 0) & (self.prediction[left] == self.prediction[right])]] = -1
        return replace(self, feature=feature)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        found = np.zeros(len(x), np.int64)
        for rows, nodes in self.paths(x):
            found[rows] = nodes
        return found


def trees_of(nodes: DataFrame) -> list[Tree]:
    """The trees of a node table; as many rows as the model has nodes."""
    by_tree: dict[int, list] = {}
    shared = "stats" in nodes.columns
    for r in nodes.orderBy("tree", "node").collect():
        by_tree.setdefault(r["tree"], []).append(r)
    found = []
    for mine in by_tree.values():
        size = max([r["node"] for r in mine]) + 1
        width = max([r["categories"] for r in mine] + [0]) + 1
        feature, left, right = (np.full(size, -1, np.int64) for _ in range(3))
        threshold, prediction, goes_left = np.full(size, np.nan), np.zeros(size), np.zeros((size, width), bool)
        reached, share = np.zeros(size), np.zeros(size)
        for r in mine:
            n = r["node"]
            feature[n], left[n], right[n], prediction[n] = r["feature"], r["left"], r["right"], r["prediction"]
            reached[n] = r["rows"]
            stats = (r["stats"] if shared else None) or []
            share[n] = stats[1] / sum(stats) if len(stats) > 1 and sum(stats) else 0.0
            if r["feature"] >= 0 and r["categories"] >= 0:
                goes_left[n, np.array(r["split"], np.int64)] = True
                goes_left[n, r["categories"] :] = _unseen_left(r)
            elif r["feature"] >= 0:
                threshold[n] = r["split"][0]
        found.append(Tree(feature, threshold, goes_left, left, right, prediction, reached, share))
    return found


def rules_table(nodes: DataFrame) -> DataFrame:
    """One row per leaf and condition on the way to it: which side of the split the feature is on, and the leaf's value.

    The root of a tree without split is a rule with one condition that holds always (no side).
    """
    by_tree: dict[int, dict] = {}
    for r in nodes.collect():
        by_tree.setdefault(r["tree"], {})[r["node"]] = r
    rows = []
    for tree, known in by_tree.items():
        ways: list[tuple[int, list[tuple[int, str, list[float]]]]] = [(0, [])]
        while ways:
            node, way = ways.pop()
            r = known[node]
            if r["feature"] < 0:
                rows += [(tree, node, i, *c, r["prediction"]) for i, c in enumerate(way or [(-1, "", [])])]
                continue
            split, sides = list(r["split"]), ("<=", ">")
            if r["categories"] >= 0 and _unseen_left(r):
                split, sides = [float(c) for c in range(r["categories"]) if c not in split], ("not in", "in")
            elif r["categories"] >= 0:
                sides = ("in", "not in")
            ways += [(to, [*way, (r["feature"], side, split)]) for to, side in zip((r["left"], r["right"]), sides)]
    return nodes.sparkSession.createDataFrame(rows, RULES)


def _holds(values: Column, feature: int, side: str, split: Sequence[float]) -> Column:
    value = values[feature] if side else None
    match side:
        case "<=":
            return value <= split[0]
        case ">":
            return value > split[0]
        case "in":
            return value.isin(*split) if split else F.lit(False)
        case "not in":
            return ~value.isin(*split) if split else F.lit(True)
    return F.lit(True)


def by_rules(df: DataFrame, rules: DataFrame, features: str = "features", name: str = "by_rules") -> DataFrame:
    """Add the value of the one rule of a single tree whose conditions all hold."""
    found: dict[int, list] = {}
    for r in rules.orderBy("rule", "place").collect():  # leaves times depth
        found.setdefault(r["rule"], []).append(r)
    values = F.col("_values")
    cases = [
        F.when(reduce(and_, [_holds(values, r["feature"], r["side"], r["split"]) for r in rows]), rows[0]["value"])
        for rows in found.values()
    ]
    return df.withColumn("_values", vector_to_array(features)).withColumn(name, F.coalesce(*cases)).drop("_values")


def categorical_features(df: DataFrame, features: str = "features") -> dict[int, int]:
    """Number of values of every feature that is a category, by its place in the vector."""
    attributes = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    binary = {a["idx"]: 2 for a in attributes.get("binary", [])}
    return binary | {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attributes.get("nominal", [])}


@dataclass(frozen=True)
class _Bins:
    """Per feature either the thresholds that occur in the trees, or its categories."""

    cuts: tuple[np.ndarray, ...]
    categories: dict[int, int]
    starts: np.ndarray

    @classmethod
    def of(cls, trees: Sequence[Tree], size: int, categories: dict[int, int]) -> _Bins:
        cuts = []
        for j in range(size):
            used = np.concatenate([t.threshold[t.feature == j] for t in trees])
            cuts.append(np.unique(used[~np.isnan(used)]))
        widths = [categories.get(j, len(c) + 1) for j, c in enumerate(cuts)]
        return cls(tuple(cuts), categories, np.concatenate([[0], np.cumsum(widths)]))

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Per row and feature the number of its bin."""
        found = np.empty(x.shape, np.int64)
        for j, cuts in enumerate(self.cuts):
            found[:, j] = x[:, j] if j in self.categories else np.searchsorted(cuts, x[:, j], "left")
        return found

    def on_bins(self, tree: Tree) -> Tree:
        """The tree that sends bins where ``tree`` sends values."""
        at = [np.searchsorted(self.cuts[j], v) if j >= 0 and not np.isnan(v) else np.nan for j, v in zip(tree.feature, tree.threshold)]
        return replace(tree, threshold=np.array(at, np.float64))


def _statistics(label: np.ndarray, classes: int) -> np.ndarray:
    """What a node sums up: rows per class, or number, sum and squares of labels."""
    if classes:
        return (label[:, None] == np.arange(classes)).astype(np.float64)
    return np.stack([np.ones(len(label)), label, label * label], axis=1)


def _held_nodes(trees: Sequence[Tree], most: int) -> list[np.ndarray]:
    """Per tree the places of its nodes among the ``most`` that most rows reach, -1 for the others. Above a held node all are held."""
    reached = np.concatenate([t.reached for t in trees])
    first = np.argsort(-reached, kind="stable")[:most]
    place = np.full(len(reached), -1, np.int64)
    place[first] = np.arange(len(first))
    return np.split(place, np.cumsum([len(t.reached) for t in trees])[:-1])


_PART = "tree int, node int, feature int, bin int, sums array<double>, bins binary, label double"


def _part(tree, node, feature, at, sums, bins, label) -> pa.RecordBatch:
    ints = [pa.array(c, pa.int32()) for c in (tree, node, feature, at)]
    arrays = [*ints, pa.array(sums, pa.list_(pa.float64())), pa.array(bins, pa.binary()), pa.array(label, pa.float64())]
    return pa.RecordBatch.from_arrays(arrays, ["tree", "node", "feature", "bin", "sums", "bins", "label"])


def _histogram(trees: Sequence[Tree], weights: Sequence[float], bins: _Bins, held: Sequence[np.ndarray], classes: int, boosted: bool):
    """Rows (feature array, label) to sums per held node, feature and bin, and to rows (no feature) at the first node that isn't held.

    The label of a boosted tree is twice what the weighted trees before it leave of the label.
    """
    size, total = classes or 3, int(bins.starts[-1])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((sum((h >= 0).sum() for h in held) * total, size))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, len(bins.cuts))
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            binned, sofar = bins.bins(x), np.zeros(len(label))
            place, packed = binned + bins.starts[:-1], binned.astype("<u2")
            for i, (tree, weight) in enumerate(zip(trees, weights)):
                own = 2.0 * (label - sofar) if boosted and i else label
                statistics, leaf = _statistics(own, classes), np.zeros(len(x), np.int64)
                entered = np.full(len(x), -1, np.int64)
                for rows, nodes in tree.paths(x):
                    leaf[rows] = nodes
                    at = held[i][nodes]
                    here, new = rows[at >= 0], (at < 0) & (entered[rows] < 0)
                    entered[rows[new]] = nodes[new]
                    for j in range(x.shape[1]):
                        np.add.at(sums, at[at >= 0] * total + place[here, j], statistics[here])
                sofar += weight * tree.prediction[leaf]
                sent = np.flatnonzero(entered >= 0)
                none = [None] * len(sent)
                yield _part(np.full(len(sent), i), entered[sent], np.full(len(sent), -1), none, none, [r.tobytes() for r in packed[sent]], own[sent])
        feature_of = np.repeat(np.arange(len(bins.cuts)), np.diff(bins.starts))
        for i, places in enumerate(held):
            for node in np.flatnonzero(places >= 0):
                table = sums[places[node] * total : (places[node] + 1) * total]
                slot = np.flatnonzero(table.any(axis=1))
                feature, none = feature_of[slot], [None] * len(slot)
                yield _part(np.full(len(slot), i), np.full(len(slot), node), feature, slot - bins.starts[feature], table[slot].tolist(), none, none)

    return add_up


def _impurities(s: np.ndarray, kind: str) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "variance":
            return s[:, 2] / s[:, 0] - (s[:, 1] / s[:, 0]) ** 2
        shares = s / s.sum(axis=1)[:, None]
        if kind == "gini":
            return 1.0 - (shares * shares).sum(axis=1)
        return -np.where(shares > 0, shares * np.log2(shares), 0.0).sum(axis=1)


def _best_gain(table: np.ndarray, whole: np.ndarray, bins: _Bins, kind: str) -> float | None:
    """The highest gain of all cuts of all features, from the sums per bin of one node."""
    count = (lambda s: s[:, 0]) if kind == "variance" else (lambda s: s.sum(axis=1))
    lefts = []
    for j, (a, b) in enumerate(zip(bins.starts[:-1], bins.starts[1:])):
        of_feature = table[a:b]
        if j in bins.categories:
            of_feature = of_feature[count(of_feature) > 0]
            of_feature = of_feature[np.argsort(of_feature[:, 1] / count(of_feature), kind="stable")]
        lefts.append(np.cumsum(of_feature, axis=0))
    left = np.concatenate(lefts)
    n, nl = count(whole[None])[0], count(left)
    left = left[(nl > 0) & (nl < n)]
    if not len(left):
        return None
    right, nl = whole - left, count(left)
    gains = _impurities(whole[None], kind)[0] - nl / n * _impurities(left, kind) - (n - nl) / n * _impurities(right, kind)
    return float(gains.max())


def _nodes_found(rows: list[tuple], size: int) -> pa.Table:
    columns = list(zip(*rows)) or [()] * (3 + size)
    kinds = [pa.int32(), pa.int32(), *[pa.float64()] * (1 + size)]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(["tree", "node", "best", *[f"s{k}" for k in range(size)]], columns, kinds)})


def _held_node(bins: _Bins, size: int, kind: str):
    def best(group: pa.Table) -> pa.Table:
        sums = group["sums"].combine_chunks().flatten().to_numpy().reshape(-1, size)
        feature, table = group["feature"].to_numpy(), np.zeros((int(bins.starts[-1]), size))
        table[bins.starts[feature] + group["bin"].to_numpy()] = sums
        whole = sums[feature == feature[0]].sum(axis=0)
        return _nodes_found([(group["tree"][0].as_py(), group["node"][0].as_py(), _best_gain(table, whole, bins, kind), *whole)], size)

    return best


def _below(trees: Sequence[Tree], bins: _Bins, classes: int, kind: str):
    size, total, on_bins = classes or 3, int(bins.starts[-1]), [bins.on_bins(t) for t in trees]

    def sum_up(group: pa.Table) -> pa.Table:
        number, start = group["tree"][0].as_py(), group["node"][0].as_py()
        tree = on_bins[number]
        x = np.frombuffer(b"".join(group["bins"].to_pylist()), "<u2").reshape(group.num_rows, len(bins.cuts))
        statistics, found = _statistics(group["label"].to_numpy(), classes), []
        place = x + bins.starts[:-1]
        for rows, nodes in tree.paths(x, start):
            order = np.argsort(nodes, kind="stable")
            for mine in np.split(rows[order], np.flatnonzero(np.diff(nodes[order])) + 1):
                node = int(nodes[np.searchsorted(rows, mine[0])])
                own, best = statistics[mine], None
                whole = own.sum(axis=0)
                if tree.feature[node] >= 0:
                    at = place[mine].ravel()
                    table = np.stack([np.bincount(at, np.repeat(own[:, k], place.shape[1]), total) for k in range(size)], axis=1)
                    best = _best_gain(table, whole, bins, kind)
                found.append((number, node, best, *whole))
        return _nodes_found(found, size)

    return sum_up


def _rows_in(s: Sequence[Column], classes: int) -> Column:
    return reduce(lambda a, b: a + b, s) if classes else s[0]


def _impurity(s: Sequence[Column], kind: str) -> Column:
    if kind == "variance":
        return s[2] / s[0] - (s[1] / s[0]) * (s[1] / s[0])
    n = reduce(lambda a, b: a + b, s)
    shares = [x / n for x in s]
    if kind == "gini":
        return 1.0 - reduce(lambda a, b: a + b, [p * p for p in shares])
    return -reduce(lambda a, b: a + b, [F.when(p > 0, p * F.log2(p)).otherwise(0.0) for p in shares])


def _gain(whole: Sequence[Column], left: Sequence[Column], kind: str) -> Column:
    classes = kind != "variance"
    right = [w - x for w, x in zip(whole, left)]
    n, nl, nr = (_rows_in(s, classes) for s in (whole, left, right))
    gain = _impurity(whole, kind) - nl / n * _impurity(left, kind) - nr / n * _impurity(right, kind)
    return F.when((nl > 0) & (nr > 0), gain)


def check_nodes(
    prepared: DataFrame, nodes: DataFrame, weights: Sequence[float], kind: str, label: str = "label",
    features: str = "features", boosted: bool = False,
) -> DataFrame:
    """One row per node: is its number of rows, gain, choice of split and value what the training rows say?

    ``prepared`` are the rows the trees were trained on, with assembled ``features``. A split is compared with
    every threshold of any node of the model, on all features, and with every cut of the categories ordered by
    their mean label; ``beaten`` says that one of these has a higher gain.
    """
    trees, categories = trees_of(nodes), categorical_features(prepared, features)
    first = prepared.select(vector_to_array(features).alias("x")).first()
    size = len(first["x"]) if first else 0
    classes = 0 if kind == "variance" else int(prepared.agg(F.max(label)).first()[0] or 0) + 1
    classes = max(classes, 2) if kind != "variance" else 0
    names = [f"s{k}" for k in range(classes or 3)]
    bins = _Bins.of(trees, size, categories)
    held = _held_nodes(trees, max(1, HELD_SUMS // (int(bins.starts[-1]) * len(names) or 1)))
    rows = prepared.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("label"))
    parts = staged(rows.mapInArrow(_histogram(trees, weights, bins, held, classes, boosted), _PART), "histogram")
    schema = "tree int, node int, best double, " + ", ".join(f"{s} double" for s in names)
    summed = parts.filter("feature >= 0").groupBy("tree", "node", "feature", "bin").agg(
        F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(len(names))]).alias("sums")
    )
    above = summed.groupBy("tree", "node").applyInArrow(_held_node(bins, len(names), kind), schema)
    below = parts.filter("feature < 0").groupBy("tree", "node").applyInArrow(_below(trees, bins, classes, kind), schema)
    best = staged(above.unionByName(below), "nodes")
    discard(parts)
    s = [F.col(n) for n in names]
    reached = nodes.join(best, ["tree", "node"], "left")
    child = best.select("tree", F.col("node").alias("left"), *[F.col(f"s{k}").alias(f"c{k}") for k in range(len(s))])
    whole_node = reached.join(child, ["tree", "left"], "left")
    own = _gain(s, [F.col(f"c{k}") for k in range(len(s))], kind)
    if classes:
        most = F.array(*s)
        value = (F.array_position(most, F.array_max(most)) - 1).cast("double")
    else:
        value = s[1] / s[0]
    near = 1e-6 * (1.0 + F.abs("impurity"))
    inner = F.col("feature") >= 0
    return whole_node.select(
        "tree",
        "node",
        inner.alias("inner"),
        (~F.col("rows").cast("double").eqNullSafe(_rows_in(s, classes))).alias("wrong_rows"),
        (inner & ~F.coalesce(F.abs(F.col("gain") - own) <= near, F.lit(False))).alias("wrong_gain"),
        (inner & ~F.coalesce(F.col("best") <= F.col("gain") + near, F.lit(False))).alias("beaten"),
        (~F.coalesce(F.abs(F.col("prediction") - value) <= 1e-6 * (1.0 + F.abs(value)), F.lit(False))).alias("wrong_value"),
    )


def score_by_nodes(df: DataFrame, trees: Sequence[Tree], weights: Sequence[float], features: str = "features", name: str = "by_nodes") -> DataFrame:
    """Add the weighted sum of the leaf values of every tree."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 1))
        return pa.array(sum(w * t.prediction[t.leaves(x)] for t, w in zip(trees, weights)))

    return df.withColumn(name, score(vector_to_array(features)))


@dataclass(frozen=True)
class CutTree:
    """A fitted single tree, and the stages before it, cut at a depth."""

    stages: tuple
    tree: Tree

    @classmethod
    def at_depths(cls, fitted, spark, depths: Sequence[int]) -> list[CutTree]:
        """``fitted`` (a tree, or a pipeline with one at its end) cut at each of ``depths``."""
        stages = tuple(getattr(fitted, "stages", [fitted]))
        tree = trees_of(node_table(stages[-1], spark))[0]
        return [cls(stages[:-1], tree.cut(d)) for d in depths]

    def transform(self, df: DataFrame) -> DataFrame:
        return score_by_nodes(reduce(lambda rows, stage: stage.transform(rows), self.stages, df), [self.tree], [1.0], name="prediction")


def same_when_cut(estimator, numTrees: int, maxBins: int, depth: int, features: int, classes: int = 2) -> bool:
    """Whether a forest cut at ``depth`` is the one that Spark trains with this depth.

    Spark draws the features of a node when the node's turn comes. As long as all nodes of a level fit into one step, these turns come level
    by level, whatever is below, so the draws above ``depth`` are the same.
    """
    node = 8 * classes * features * max(maxBins, 2)
    return node * numTrees * 2 ** max(depth - 1, 0) <= estimator.getMaxMemoryInMB() << 20


def forest_scores(model, df: DataFrame, depths: Sequence[int], features: str = "features") -> DataFrame:
    """``df`` with ``raw0``, ``raw1``, ...: what the forest cut at each of ``depths`` has as raw prediction of class 1; one pass."""
    whole = trees_of(node_table(model, df.sparkSession))
    cut = [[t.cut(d).merged() for t in whole] for d in depths]

    @F.arrow_udf("array<double>")
    def score(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 1))
        sums = np.zeros((len(column), len(cut)))
        for i, trees in enumerate(cut):
            for t in trees:  # one after the other, as Spark adds them up
                sums[:, i] += t.share[t.leaves(x)]
        return pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), len(cut)).cast(pa.list_(pa.float64()))

    scored = df.withColumn("_raw", score(vector_to_array(features)))
    return scored.withColumns({f"raw{i}": F.col("_raw")[i] for i in range(len(depths))}).drop("_raw")
