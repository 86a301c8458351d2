"""Nulls, empty texts, repeated rows, clashing columns and empty tables in every query."""

import pytest

from tallyframe.llm.queries import QUERIES

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, row long"
LONG = " ".join(f"word{i}" for i in range(3000))


def folder(spark, path, documents, benchmark, labels, vectors):
    frames = {
        "documents": (documents, DOCUMENTS),
        "benchmark": (benchmark, "item_id long, text string"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "embeddings": (vectors, "vec_id long, embedding array<float>, label int"),
        "conversations": ([(d[0], d[0], d[2], d[1]) for d in documents], "conv_id long, turn long, role string, text string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    texts = [None, "", " \n\t", "one", "one", LONG, LONG, "12 34 ...", "Eine Zeile mit genug Zeichen\n\nEine Zeile mit genug Zeichen"]
    documents = [(i if i != 3 else None, t, "en" if i % 2 else None, "s" if i % 3 else None, 1, 2, 3.0, 4) for i, t in enumerate(texts)]
    documents.append(documents[5])
    benchmark = [(1, None), (2, ""), (3, "ONE"), (None, "x y"), (4, LONG[:200]), (4, LONG[:200])]
    labels = [(5, 1, 0), (6, 0, 0), (6, None, 1), (None, 1, 1), (8, 7, 0)]
    one = [1.0, 0.0, 0.0, 0.0]
    vectors = [(0, one, 1), (1, None, 1), (2, [0.0] * 4, 1), (3, [1.0, None, 0.0, 0.0], 1), (4, [float("nan")] * 4, 1), (5, one, 1), (5, one, 1), (None, one, 1), (6, [1.0], 1)]
    return folder(spark, tmp_path_factory.mktemp("odd"), documents, benchmark, labels, vectors), len(documents)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows(spark, odd, name):
    rows = QUERIES[name](spark, odd[0]).collect()
    if name == "op7_nearest":
        assert [(r.query_id, r.rank, r.vec_id) for r in sorted(rows)] == [(0, 1, 5), (0, 2, 5)]
    elif name == "op11_turn_repair":
        assert len(rows) == odd[1] - 1  # one is there twice
    elif name == "op12_filter_audit":
        assert len(rows) == 2 * 600
    elif name == "op13_top_products":
        assert {r.query_id for r in rows} == {0}
        assert len(rows) == 4
    else:
        assert len(rows) == odd[1]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []
