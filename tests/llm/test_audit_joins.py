"""Salted copies are several times larger than what Spark takes them for, so no join of the audit builds them in the driver."""

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import audit


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_copies_are_not_broadcast(spark, tmp_path, how):
    spark.range(100).select("id", (F.col("id") * 2).alias("twice")).write.parquet(str(tmp_path / "small"))
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (7, "c"), (None, "d"), (200, "e")], "id long, name string")
    joined = audit._salted(rows, spark.read.parquet(str(tmp_path / "small")), "id", F.xxhash64("name"), how)
    expected = {("a", 2), ("b", 2), ("c", 14), ("d", None), ("e", None)}
    assert {(r.name, r.twice) for r in joined.collect()} == {e for e in expected if how == "left" or e[1]}
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
