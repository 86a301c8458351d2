"""Every context word has a restaurant of its own, whatever the number of words."""

import numpy as np
from pyspark.sql import functions as F

from tallyframe.llm import lm


def test_contexts_do_not_share_customers(spark):
    n = 150_000  # more than 16 bits can tell apart
    rows = [(i, " ".join(f"left{j} right{j}" for j in range(i, n, 50))) for i in range(50)]
    rows.append((50, "left7 unheard"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = lm.fit(docs, F.col("doc_id") < 50, burn_in=0, samples=1)
    customers, parts = {}, 0
    for row in model.state.collect():
        part, parts = lm.Seating.read(row.asDict()), parts + 1
        for i, sums in enumerate(part.seats):
            for key, x in zip(part.keys.tolist(), sums.tolist(), strict=True):
                assert customers.setdefault((key, i), x) == x  # every part has the same sums
    sums = np.array([x for (_, i), x in customers.items() if i == 0])
    assert parts > 1 and sums.sum() == 2 * n + 50  # one token after each word and at each start
    assert np.sort(sums)[::-1][:2].tolist() == [50, 1] and (sums <= 50).all()
    assert (sums == 0).sum() == 1  # what follows a word that was not learned
    tables = np.array([x for (_, i), x in customers.items() if i == 1])
    assert ((tables >= 1) == (sums >= 1)).all()
