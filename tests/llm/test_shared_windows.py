"""One window in many items: every one of them is named."""

from tallyframe.llm import decontaminate


def test_one_window_of_many_items(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    bench = [(f"i{i:05}", passage) for i in range(3000)] + [("other", "a b c d e f g h i j"), ("null", None)]
    benchmark = spark.createDataFrame(bench, "item_id string, text string")
    docs = [(i, f"before {passage} after") for i in range(40)] + [(50, f"{passage} a b c d e f g h i j"), (51, "clean"), (52, None)]
    found = {r["doc_id"]: r for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    shared = sorted(b[0] for b in bench[:3000])
    assert all(found[i]["items"] == shared and found[i]["n_hit"] == 12 for i in range(40))
    assert found[50]["items"] == sorted([*shared, "other"]) and found[50]["n_hit"] == 22
    assert found[51]["items"] == [] and found[52]["n_words"] == 0
