"""Parts and homes of the language model follow the texts, not how the session deals its shuffles."""

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import lm


def _fitted(docs):
    model = lm.fit(docs, F.col("doc_id") < 30, burn_in=0, samples=1)
    return model, sorted(lm.score(docs, model, F.col("doc_id") >= 30).collect())


def test_rows_sent_do_not_grow_with_shuffle_partitions(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 97}" for j in range(200))) for i in range(40)], "doc_id long, text string")
    docs = docs.repartition(2)
    first, scores = _fitted(docs)
    monkeypatch.setattr(lm, "PART_BYTES", 1 << 10)
    monkeypatch.setattr(lm, "HOME_BYTES", 4 << 10)
    many, others = _fitted(docs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        wide, same = _fitted(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert first.parts == lm.LEAST_PARTS and many.parts == wide.parts == -(-size // 1024) > lm.LEAST_PARTS
    assert [r.doc_id for r in same] == list(range(40))
    assert [r.score for r in same] == pytest.approx([r.score for r in others], abs=1e-9)
    for a, b in zip(scores, others, strict=True):  # counts don't depend on the parts
        assert (a.n_tokens, a.n_known, a.held_out) == (b.n_tokens, b.n_known, b.held_out)
        assert a.base_score == pytest.approx(b.base_score, abs=1e-9)
