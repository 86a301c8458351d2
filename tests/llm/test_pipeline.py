"""The pipeline's stages on the small tables, each against brute force on its own input."""

import re
import zlib
from collections import Counter

import numpy as np
from test_operators import ascii_lower, components_by_force

import corpus_pipeline
from tallyframe.llm.queries import table, tokenizer_file
from tallyframe.session import staged

SMALL = "/root/testdata/sf0.001"
SPLIT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [w for w in SPLIT.split(ascii_lower(text or "")) if w]


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, SMALL, "documents")
    columns = docs.columns

    identified = staged(stages["language_id"](spark, docs, SMALL), "test")
    kept = sorted(identified.collect())
    assert identified.columns == columns and len(kept) >= 0.95 * docs.count()

    single = staged(stages["jaccard_join"](spark, identified, SMALL), "test")
    groups = components_by_force(kept)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in groups.items() if c == i)

    clean = staged(stages["decontamination"](spark, single, SMALL), "test")
    items = [words(r.text) for r in table(spark, SMALL, "benchmark").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(len(w) - 9, 1)) if w}
    sizes = {len(w) for w in windows}

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    assert clean.columns == columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect() if not hit(r.text))

    mix = staged(stages["mixing"](spark, clean, SMALL), "test")
    times = Counter(r.doc_id for r in mix.collect())
    assert mix.columns == columns and max(times.values()) <= 2
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in clean.collect()}
    largest = max(size.values())
    taken = sum(size[i] * n for i, n in times.items())
    sources = len({r.source for r in clean.collect()})
    assert abs(taken - 1.5 * sum(size.values())) <= largest * sources

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    rows = sorted(stages["token_ids"](spark, mix, SMALL).collect(), key=lambda r: r.start)
    start = 0
    for r, d in zip(rows, sorted(mix.collect(), key=lambda d: (d.doc_id, d.text)), strict=True):
        ids = tokenizer.encode(d.text, add_special_tokens=False).ids + [2]
        assert tuple(r) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
