"""Lines that stand in several shard groups, and counts that the arrays decide."""

import random
from collections import Counter

import pytest

from tallyframe.llm import linededup


def by_hand(rows, least_chars, least_docs):
    key = lambda x: x.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    holders: dict[str, Counter] = {}
    for at, (doc, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders.setdefault(k, []).append(doc)
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        stay = []
        for x in parts:
            held = holders.get(key(x), [])
            ids = [d for d in held if d is not None]
            if len(held) >= least_docs and ids and doc != max(ids):
                continue
            stay.append(x)
        out.append((doc, len(parts), len(parts) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    common = [f"A common line, number {i}" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(common) + " " * rng.randint(0, 2) for _ in range(rng.randint(0, 9)))) for i in range(50)]
    rows += [(100, "in two documents, only two"), (101, "In two documents, only two")]
    rows += [(None, common[0]), (None, None), (7, common[1]), (7, common[1]), (102, ""), (103, (common[2] + "\n") * 3000)]
    return rows


@pytest.mark.parametrize("least_docs", [2, 3, 5])
def test_several_groups_like_one(spark, rows, monkeypatch, least_docs):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 8)
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, row string, dropped string")
    for size in (1, 1 << 26):  # a group per shard, one group
        found = linededup.deduplicated(docs, least_docs=least_docs, group_bytes=size)
        assert found.columns == [*docs.columns, "_lines"]
        got = [(r["doc_id"], *r["_lines"]) for r in found.collect()]
        assert sorted(got, key=str) == by_hand(rows, 20, least_docs)
