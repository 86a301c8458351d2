"""The queries that SQL can't state, against brute force on the whole middle tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from check_queries import connect, differences

from tallyframe.llm.queries import QUERIES, SQL, table, tokenizer_file

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(MIDDLE)


@pytest.fixture(scope="module")
def documents(spark):
    return sorted(table(spark, MIDDLE, "documents").collect(), key=lambda r: r.doc_id)


def rows(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, MIDDLE).collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, MIDDLE, name) is None


def ascii_lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_token_ids(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    found, start = rows(spark, "op3_token_ids"), 0
    assert len(found) == len(documents)
    for d in documents:
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(found[d.doc_id]) == (d.doc_id, start, len(ids), crc)
        start += len(ids)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_personal(kind, text):
    n = [int(c) for c in text if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        twice = [sum(divmod(2 * x, 10)) for x in n[-2::-2]]
        return 16 <= len(n) <= 19 and (sum(n[::-2]) + sum(twice)) % 10 == 0
    return kind == "email" or 8 <= len(n) <= 15


def test_personal_data(spark, documents):
    found = rows(spark, "op4_pii")
    more = 0
    for d in documents:
        base = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, d.text or "") if is_personal(k, m[0])]
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = found[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, *_ in base) for k in PATTERNS]
        spans = [s for s in r.spans.split(",") if s]
        assert set(want.split(",")) - {""} <= set(spans)
        more += len(spans) - len(base)
        if not re.search(r"[0-9@=]", d.text or ""):
            assert not spans  # clean texts stay clean
    assert more > 0


def test_language_model(spark, documents):
    found = rows(spark, "op5_lm_scoring")
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 5 == 1 for d in documents}
    words = {d.doc_id: [*WORDS.findall(ascii_lower(d.text or "")), None] for d in documents}
    counts = Counter(w for d in documents if not held[d.doc_id] for w in words[d.doc_id])
    n, v = sum(counts.values()), len(counts)
    ours = base = 0.0
    for d in documents:
        r = found[d.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d.doc_id], len(words[d.doc_id]), n)
        assert r.n_known == sum(w in counts for w in words[d.doc_id])
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words[d.doc_id])
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert r.score < 0
        if r.held_out:
            ours, base = ours + r.score, base + r.base_score
    assert ours > base  # better than the unigrams on texts not learned from


def components_by_force(documents, size=5):
    sets = {}
    for d in documents:
        w = WORDS.findall(ascii_lower(d.text or ""))
        sets[d.doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = Counter()
    for ids in where.values():
        for j, a in enumerate(ids):
            for b in ids[j + 1 :]:
                shared[a, b] += 1
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_components(spark, documents):
    want = components_by_force(documents)
    found = rows(spark, "op6_jaccard_join")
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == want
    assert any(c != i for i, (_, c) in want.items())


def test_neighbours_recall(spark):
    data = sorted(table(spark, MIDDLE, "embeddings").collect(), key=lambda r: r.vec_id)
    ids = np.array([r.vec_id for r in data])
    unit = np.array([r.embedding for r in data], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = defaultdict(dict)
    for r in QUERIES["op7_nearest"](spark, MIDDLE).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = 0
    queries = ids[ids % 50 == 0]
    for q in queries:
        score = unit @ unit[ids == q][0]
        best = [i for i in ids[np.lexsort((ids, -score))] if i != q][:5]
        mine = found[int(q)]
        assert sorted(mine) == [1, 2, 3, 4, 5]
        hits += len({i for i, _ in mine.values()} & set(best))
        for i, s in mine.values():
            assert s == pytest.approx(score[ids == i][0], abs=1e-12)
        assert [s for _, s in (mine[k] for k in range(1, 6))] == sorted((s for _, s in mine.values()), reverse=True)
    assert hits >= 0.9 * 5 * len(queries)


def test_language_id(spark, documents):
    found = rows(spark, "op8_language_id")
    assert len(found) == len(documents)
    right = n = 0
    for d in documents:
        r = found[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in d.text or ""):
            assert r.lang_pred == "und"
        elif r.held_out:
            n, right = n + 1, right + (r.lang_pred == d.lang)
    assert right >= 0.95 * n


def test_quality(spark):
    found = rows(spark, "op10_quality")
    labels = {r.doc_id: r.quality for r in table(spark, MIDDLE, "labels").collect()}
    scored = [(found[i].score, y) for i, y in labels.items() if found[i].held_out]
    assert all(r.predicted == (r.score >= 0.3) for r in found.values())
    pairs = [(a > b) + 0.5 * (a == b) for a, y in scored for b, z in scored if y == 1 and z == 0]
    assert np.mean(pairs) > 0.9
