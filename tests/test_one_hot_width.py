"""One-hot columns follow the categories that are there, not the four of the given tables."""

import pytest
from pyspark.sql import functions as F

from tallyframe.plans import features as P
from tallyframe.plans.tables import PAGE_NUMBERS


@pytest.mark.parametrize("n", [3, 5])
def test_width_is_that_of_the_data(spark, tables, monkeypatch, n):
    pages = P.clean_pages(tables).limit(200).withColumn(
        "alchemy_category", F.concat(F.lit("c"), F.pmod(F.xxhash64("url"), F.lit(n)).cast("string"))
    ).cache()
    monkeypatch.setattr(P, "clean_pages", lambda t: pages)
    coded = P.ftr_one_hot(tables)
    assert coded.columns == ["url", *[f"is{i}" for i in range(n)]]
    assert all(sum(r[1:]) == 1.0 for r in coded.collect())
    built = P.ftr_assemble(tables)
    assert built.columns == ["url", "label", *[f"x{i}" for i in range(n + len(PAGE_NUMBERS))]]
    want = {r.url: [float(r[c]) for c in PAGE_NUMBERS] for r in pages.collect()}
    assert all(list(r[2 + n :]) == want[r.url] and sum(r[2 : 2 + n]) == 1.0 for r in built.collect())
