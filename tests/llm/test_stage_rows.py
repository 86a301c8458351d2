"""Every pipeline stage on nulls, empty and repeated rows, and columns that clash with names used inside."""

import pytest

import corpus_pipeline

BENCHMARK = "the quick brown fox jumps over the lazy dog while seven wizards brew strange potions in the old tower"
NEAR = " ".join(f"word{i}" for i in range(60))
EXTRA = "row long, _row long, whole string, _language string, _source string, _copy int, _times int, size long, component_id long, _other long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("stages")
    spark.createDataFrame([(1, BENCHMARK), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def frame(spark, rows):
    extra = (1, 2, "w", "l", "s", 3, 4, 5, 6, 7)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *extra) for i, t, s in rows], SCHEMA)


def run(spark, folder, name, rows):
    docs = frame(spark, rows)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    if name != "token_ids":
        assert out.columns == docs.columns
        assert all((r.row, r._row, r.whole, r._language, r._source, r._copy, r.size, r._other) == (1, 2, "w", "l", "s", 3, 5, 7) for r in out.collect())
    return out.collect()


def test_near_copies_are_judged_by_row(spark, folder):
    rows = [
        (1, NEAR, "a"), (5, NEAR + " end", "a"), (5, "a text of its own that no other row has", "a"), (None, NEAR, "b"), (None, "lone row without id at all", "b"),
        (7, None, "a"), (8, "", None), (9, "", None), (2, "same again and again here", "a"), (2, "same again and again here", "a"), (None, NEAR, None),
    ]
    found = sorted(((r.doc_id, r.text) for r in run(spark, folder, "jaccard_join", rows)), key=repr)
    wanted = [
        (1, NEAR), (5, "a text of its own that no other row has"), (None, "lone row without id at all"), (7, None), (8, ""), (9, ""),
        (2, "same again and again here"),
    ]
    assert found == sorted(wanted, key=repr)


def test_benchmark_text_goes(spark, folder):
    rows = [(1, f"before {BENCHMARK} after", "a"), (1, "clean text with the same id", "a"), (None, BENCHMARK, "a"), (2, None, None), (3, "", "b")]
    found = [r.text for r in run(spark, folder, "decontamination", rows)]
    assert sorted(found, key=repr) == sorted(["clean text with the same id", None, ""], key=repr)


def test_mix_takes_whole_rows(spark, folder):
    rows = [(i, f"words of document {i} " * (i % 4), ("a", "b", None)[i % 3]) for i in range(60)] + [(None, None, "c"), (None, "x y", None)]
    found = run(spark, folder, "mixing", rows)
    assert max(sum(r.doc_id == i and r.text == t for r in found) for i, t, _ in rows) <= 2
    assert {(r.doc_id, r.text, r.source) for r in found} <= set(rows)
    words = sum(len(t.split()) for _, t, _ in rows if t)
    assert abs(sum(len((r.text or "").split()) for r in found) - 1.5 * words) < 0.1 * words


def test_languages(spark, folder):
    english = "the house and the garden are near the river where the children play"
    rows = [(i, f"{english} {i}", "a") for i in range(12)] + [(20, None, "a"), (21, "", "a"), (22, "12 34", "a"), (None, english, None), (1, english, "a")]
    found = [r.text for r in run(spark, folder, "language_id", rows)]
    assert sum(t is not None and t.startswith(english) for t in found) == 14
    assert len(found) == 14


def test_ids_of_every_row(spark, folder):
    rows = [(3, "b", "a"), (None, None, "a"), (1, "", "a"), (1, "", "a"), (2, "a b c" * 1000, None)]
    found = sorted(run(spark, folder, "token_ids", rows), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 1, 2, 3]
    assert [r.start for r in found] == [0, 1, 2, 3, 3 + found[3].n_tokens]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, folder, name):
    assert run(spark, folder, name, []) == []


def test_stored_rows_are_not_written_again(spark, folder, tmp_path, monkeypatch):
    """Stages on Parquet files keep row numbers only, and the same rows stay as of a frame that is numbered and written."""
    from tallyframe import session
    from tallyframe.llm import decontaminate, shinglejoin

    rows = [(i % 9, f"{NEAR} {i % 3}" if i % 2 else f"text number {i} of its own, {BENCHMARK if i % 4 else ''}", "a") for i in range(40)]
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/docs")
    docs, texts, staged = spark.read.parquet(f"{tmp_path}/docs"), [], session.staged

    def seen(df, name, *args):
        texts.extend(f.name for f in df.schema.fields if f.name in ("whole", "text"))
        return staged(df, name, *args)

    for module in (session, decontaminate, shinglejoin):
        monkeypatch.setattr(module, "staged", seen)
    for name in ("jaccard_join", "decontamination"):
        found = sorted((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)[name](spark, docs, folder).collect())
        assert not texts
        wanted = sorted((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)[name](spark, frame(spark, rows), folder).collect())
        assert found == wanted and 0 < len(found) < 40
        texts.clear()
