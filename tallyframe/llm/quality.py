"""Quality classifier: a sparse ensemble of rules over text statistics.

The statistics are DataFrame functions and are stored once per document. Two forests of bagged
trees, one of them on balanced weights, are fitted on the labelled ones; every path of a tree is a rule, a conjunction of
thresholds on statistics. A logistic regression with lasso penalty over the rules keeps few of
them, and those are compiled into one Spark column expression, with which all documents are
scored. All labelled rows are learned from.

Null and empty texts have statistics 0 and get a score like any other. Labels that are null or
not 0 or 1 are ignored; of several labels of a document the smallest counts. Rows with a null
``doc_id`` teach nothing and are not held out. Without labels of both kinds the score is the
share of label 1, or 0.5 without any. Repeated rows count each for itself.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.langid import held_out
from tallyframe.session import staged

TREES, DEPTH = 24, 3
PENALTY = 2e-3
LEAST_SCORE = 0.3

_STATISTICS = [
    "n_chars", "n_words", "word_length", "line_words", "upper", "digits", "marks", "bangs", "bars", "symbols", "stops", "fresh_words", "fresh_lines", "run_words",
]


def statistics(text: Column) -> dict[str, Column]:
    """Doubles per text; shares are per character or per word."""
    text = F.coalesce(text, F.lit(""))
    tokens = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    chars, lines = F.length(text).cast("double"), F.split(text, "\n")
    words = F.size("_tokens").cast("double")
    per_char, per_word = F.greatest("n_chars", F.lit(1.0)), F.greatest("n_words", F.lit(1.0))
    return {
        "_tokens": tokens,
        "_lines": lines,
        "n_chars": chars,
        "n_words": words,
        "word_length": F.col("n_chars") / per_word,
        "line_words": F.col("n_words") / F.size("_lines"),
        "upper": count("[A-Z]") / per_char,
        "digits": count("[0-9]") / per_char,
        "marks": count(r"[!-/:-@\[-`{-~]") / per_char,
        "bangs": count("!") / per_char,
        "bars": count(r"\|") / per_char,
        "symbols": count(r"[#$%&*@^~<>=+]") / per_char,
        "stops": count(r"[.?!](?:[\x20\n]|$)") / per_word,
        "fresh_words": F.size(F.array_distinct("_tokens")) / per_word,
        "fresh_lines": F.size(F.array_distinct("_lines")) / F.size("_lines"),
        "run_words": count(r"(?<![^\x20\n])([^\x20\n]++)(?=\x20\1(?![^\x20\n]))") / per_word,
    }


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out and the statistics, stored."""
    out = docs.select(F.col("doc_id"), held_out(parts=5, part=0).alias("held_out"), F.col(text).alias("_text"))
    columns = statistics(F.col("_text"))
    for name in ("_tokens", "_lines", "n_chars", "n_words"):
        out = out.withColumn(name, columns.pop(name))
    out = out.withColumns(columns)
    return staged(out.select("doc_id", "held_out", *_STATISTICS), "statistics")


@dataclass(frozen=True)
class Rule:
    """All of ``parts`` (statistic, above the threshold or not, threshold) hold."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return reduce(Column.__and__, [F.col(s) > t if above else F.col(s) <= t for s, above, t in self.parts])


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


_LINE = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.Ee]+)\)")


def tree_rules(text: str, names: list[str]) -> list[Rule]:
    """The paths of a printed ensemble: every node below a root is a conjunction of conditions."""
    path: list[tuple[int, tuple[str, bool, float]]] = []
    found = []
    for line in text.split("\n"):
        if not (m := _LINE.match(line)):
            if "Tree" in line:
                path = []
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (names[int(m[3])], m[4] == ">", float(m[5]))))
        found.append(_shortest([p[1] for p in path]))
    return list(dict.fromkeys(found))


def _shortest(parts: list[tuple[str, bool, float]]) -> Rule:
    """Of several thresholds on one side of a statistic only the strictest matters."""
    strict: dict[tuple[str, bool], float] = {}
    for name, above, at in parts:
        old = strict.get((name, above), at)
        strict[name, above] = max(old, at) if above else min(old, at)
    return Rule(tuple(sorted((n, a, t) for (n, a), t in strict.items())))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> RuleModel:
    """Learn from the rows of ``stats`` that are not held out and have a label."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))
    taught = staged(stats.filter(~F.col("held_out")).join(known, "doc_id").select(*_STATISTICS, "label"), "taught")
    n, ones = taught.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        share = min(max((ones + 0.5) / (n + 1), 1e-3), 1 - 1e-3)
        return RuleModel(math.log(share / (1 - share)), [])
    features = VectorAssembler(inputCols=_STATISTICS, outputCol="features").transform(taught)
    rules: list[Rule] = []
    for seed, balanced in ((1, False), (2, True)):
        weight = F.when(F.col("label") == 1, F.lit(n / (2 * ones))).otherwise(F.lit(n / (2 * (n - ones)))) if balanced else F.lit(1.0)
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", numTrees=TREES // 2, maxDepth=DEPTH, featureSubsetStrategy="0.5", seed=seed
        ).fit(features.withColumn("weight", weight))
        rules += tree_rules(forest.toDebugString, _STATISTICS)
    rules = list(dict.fromkeys(rules))
    if not rules:
        return RuleModel(math.log(ones / (n - ones)), [])
    held = F.array(*[r.column().cast("double") for r in rules])
    table = staged(taught.select("label", held.alias("held")), "rules").select("label", array_to_vector("held").alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False).fit(table)
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), [(r, w) for r, w in zip(rules, weights, strict=True) if w])


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = measured(docs)
    model = fit(stats, labels)
    return stats.select("doc_id", "held_out", model.score().alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= LEAST_SCORE, 1).otherwise(0)
    )
