"""Gradient steps go over rows that lie on all cores."""

import random

import pytest

from tallyframe.operators import gradient as G


def test_rows_of_one_file_go_to_all_cores(spark, monkeypatch):
    rng, parts, held = random.Random(4), [], G.held
    data = [(str(i), rng.random(), rng.random(), float(rng.random() < 0.5)) for i in range(80)]
    rows = spark.createDataFrame(data, "url string, a double, b double, label double").coalesce(1)

    def seen(df):
        parts.append(df.groupBy(G.F.spark_partition_id()).count().count())
        return held(df)

    monkeypatch.setattr(G, "held", seen)
    settings = [G.Descent(3, 10.0, fraction=f) for f in (0.5, 1.0)]
    models = G.descend_all(rows, ["a", "b"], G.logistic_slope, settings, key=["url"])
    assert parts == [spark.sparkContext.defaultParallelism]
    spread = G.descend_all(rows.repartition(3), ["a", "b"], G.logistic_slope, settings, key=["url"])
    for one, other in zip(models, spread):
        assert one.weights == pytest.approx(other.weights, abs=1e-12)
