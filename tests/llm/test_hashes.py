"""Texts that collide in every polynomial hash modulo a power of two are told apart."""

import hashlib

import numpy as np
import pytest

from tallyframe.llm import arrays
from tallyframe.llm.queries import tokenizer_file
from tallyframe.llm.linededup import lines_query
from tallyframe.llm.shinglejoin import components_query
from tallyframe.llm.tokenids import ids_query
from tallyframe.session import fresh_path

BITS = [bin(i).count("1") % 2 for i in range(1024)]
ONE, OTHER = "".join("ab"[b] for b in BITS), "".join("ba"[b] for b in BITS)


def hashes(texts, which=0):
    raw = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    starts = np.concatenate([[0], ends[:-1]])
    return arrays.span_hashes(np.frombuffer(raw, np.uint8), starts, ends, which).tolist()


@pytest.mark.parametrize("which", [0, 1])
def test_span_hashes(which):
    one, other, again = hashes([ONE, OTHER, ONE], which)
    assert one == again != other
    texts = ["", "a", "b", "ab", "ba", "aa", "a" * 9_000_000, "a" * 9_000_001, "ab", "", "\x00", "\x00\x00"]
    found = hashes(texts, which)
    assert found[3] == found[8] and found[0] == found[9]
    assert len(set(found)) == len(set(texts))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_lines_components_and_ids(spark):
    texts = [f"{ONE}\nx{i}" for i in range(3)] + [OTHER]
    rows = {r.doc_id: r for r in lines_query(frame(spark, texts)).collect()}
    assert [rows[i].n_dropped for i in range(4)] == [1, 1, 0, 0]
    found = {r.doc_id: r.component_id for r in components_query(frame(spark, [ONE, OTHER, ONE])).collect()}
    assert found == {0: 0, 1: 1, 2: 0}
    ids = [r.ids_crc32 for r in sorted(ids_query(frame(spark, [ONE, OTHER]), fresh_path(spark, "hash-ids"), tokenizer_file()).collect())]
    alone = [ids_query(frame(spark, [t]), fresh_path(spark, "hash-ids"), tokenizer_file()).first().ids_crc32 for t in (ONE, OTHER)]
    assert ids == alone and ids[0] != ids[1]
    assert rows[3].kept_sha256 == hashlib.sha256(OTHER.encode()).hexdigest()
