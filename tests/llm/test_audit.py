"""The filter audit against a count that applies the filters one after the other."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import audit

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    words = WORDS.findall(text)
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def plain(documents, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    firsts = {}
    for i, text, _ in documents:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    rows = [
        (lang or "", i, fails(text or "") | {"E": i is not None and i > firsts[text or ""]}) for i, text, lang in documents
    ]
    out = {}
    for part in {r[0] for r in rows}:
        shares = Counter()
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            everyone = left
            for step, name in enumerate(order, 1):
                lost = [r for r in left if r[2][name]]
                left = [r for r in left if not r[2][name]]
                shares[name] += len(lost)
                out[part, "".join(order), step] = [
                    len(left), len(lost), sum(r[2][name] for r in everyone) - len(lost),
                    sum(r[2][name] and sum(r[2].values()) == 1 for r in everyone),
                    sum(r[1] in good for r in lost), sum(r[1] in toxic for r in lost),
                ]
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                out[part, "".join(order), step].append(shares[name])
    return out


LONG = " ".join(f"w{i}" for i in range(150))
DOCUMENTS = [
    (1, None, "en"), (2, "", "en"), (3, LONG, "en"), (4, LONG, "de"), (4, LONG, "de"), (None, LONG, "de"), (5, LONG, None),
    (6, LONG + " #", ""), (7, "AB " * 200, "en"), (8, "\x0b\x0c", None), (9, LONG + " UPPER" * 80, "en"), (10, LONG + "  ", "de"),
    (11, "word " * 200_000 + "*", "fr"), (12, "word " * 200_000 + "*", "fr"), (3, "another text", "en"), (3, LONG, "en"), (None, None, None),
]
LABELS = [(3, 1, 0), (3, None, 1), (4, 0, 1), (7, 1, 1), (None, 1, 1), (12, 1, None), (99, 1, 1)]


def frames(spark, documents, labels):
    rows = [(*d, 1, 2, 3, 4, 5) for d in documents]
    clashing = "doc_id long, text string, lang string, part int, mask int, first int, documents int, salt int"
    return spark.createDataFrame(rows, clashing), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def found(spark, documents, labels, **more):
    counts = audit.mask_counts(*frames(spark, documents, labels), **more)
    rows = audit.interactions(counts).collect()
    return {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in rows
    }


def test_odd_rows(spark):
    assert found(spark, DOCUMENTS, LABELS) == plain(DOCUMENTS, LABELS)


@pytest.mark.parametrize("hashing", [lambda t: F.lit(7).cast("long"), lambda t: F.length(t).cast("long")])
def test_hash_that_stands_for_several_texts(spark, hashing):
    assert found(spark, DOCUMENTS, LABELS, hashing=hashing) == plain(DOCUMENTS, LABELS)


def test_empty_tables(spark):
    assert found(spark, [], LABELS) == {}
    assert found(spark, DOCUMENTS, []) == plain(DOCUMENTS, [])


def test_sketch_clears_unique_hashes_only(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("h"))
    twice = hashes.unionAll(hashes.limit(100))
    filled = audit.filled_cells(twice, 1 << 15)
    kept = audit.possible_repeats(twice, filled, 1 << 15)
    repeated = {r.h for r in hashes.limit(100).collect()}
    left = [r.h for r in kept.collect()]
    assert all(left.count(h) == 2 for h in repeated)
    assert len(set(left)) < 150
