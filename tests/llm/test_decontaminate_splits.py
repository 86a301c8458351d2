"""Rows keep their numbers when a later scan splits the files in other places."""

import pytest

from tallyframe.llm import decontaminate
from tallyframe.session import staged

SPLITS = "spark.sql.files.maxPartitionBytes"
LEAK = " ".join(f"leak{i}" for i in range(10))


@pytest.fixture
def shifting(spark, tmp_path, monkeypatch):
    """Documents in eight files, and a split size that changes after every scan for occurrences."""
    rows = [(i, f"clean text of document {i} " + (LEAK if i % 3 == 0 else "")) for i in range(80)]
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(path)
    before, sizes = spark.conf.get(SPLITS), iter(["600", "128m"] * 100)

    def written(df, name):
        out = staged(df, name)
        if name == "occurrences":
            spark.conf.set(SPLITS, next(sizes))
        return out

    monkeypatch.setattr(decontaminate, "staged", written)
    spark.conf.set(SPLITS, "128m")
    yield spark.read.parquet(path)
    spark.conf.set(SPLITS, before)


def items(spark):
    return spark.createDataFrame([(1, LEAK)], "item_id long, text string")


def test_dropped_documents_are_the_contaminated_ones(spark, shifting):
    left = decontaminate.drop_contaminated(shifting, items(spark)).collect()
    assert sorted(r.doc_id for r in left) == [i for i in range(80) if i % 3]


def test_blocks_agree_on_the_rows(spark, shifting):
    found = decontaminate.contamination(shifting, items(spark), block=1).collect()
    assert sorted(r.doc_id for r in found if r.n_hit == 10) == [i for i in range(80) if i % 3 == 0]
    assert sum(r.n_hit > 0 for r in found) == 27 and len(found) == 80
