"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

An item's windows are its runs of ``WINDOW`` words (an item of fewer words is one window). A
window's tokens are its shingles of ``SHINGLE`` words. Containment needs all of them, so the
necessary prefix is one token, the one that is rarest in the documents. Per block of at most
``BLOCK`` distinct benchmark tokens, which is broadcast, one pass over the documents keeps
the places where a token of the block stands, with the words around each place. Those
occurrences give the counts that order the tokens. Joined on the prefix token, they are
bounded by length and position (the window must fit where the token stands) and verified
word by word.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Null and empty texts have
no words; an item without words has no window. Each row of the documents is one document,
also where ids repeat or are null. An item given several times counts once per ``item_id``;
a null ``item_id`` is left out of the list. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import keep, numbered, scratch, staged

WINDOW = 10
SHINGLE = 4
#: Distinct benchmark tokens that are broadcast at once; more are taken in several passes.
BLOCK = 1_000_000

#: What separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; all-ASCII texts take the faster function."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def _slice(array: str | Column, start: Column, size: Column | int) -> Column:
    return F.slice(array, start, F.lit(size) if isinstance(size, int) else size)


def _token(array: str, start: Column, size: int) -> Column:
    """The hash of ``size`` words from ``start`` (from 0), null where they don't fit."""
    whole = start + size <= F.size(array)
    return F.when(whole, F.xxhash64(F.lit(size), *[F.get(array, start + j) for j in range(size)]))


def windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(window, item_id) once per pair; ``window`` is the array of its words."""
    split = benchmark.select(F.col(item).cast("string").alias("item_id"), words(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)))
    placed = split.filter(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("at"))
    return placed.select("item_id", _slice("w", F.col("at") + 1, WINDOW).alias("window")).distinct()


def window_tokens(found: DataFrame) -> DataFrame:
    """(window, size, at, token): the shingles of each distinct window."""
    sized = found.select("window", F.least(F.size("window"), F.lit(SHINGLE)).alias("size"))
    placed = sized.select("*", F.explode(F.sequence(F.lit(0), F.size("window") - F.col("size"))).alias("at"))
    token = F.coalesce(*[F.when(F.col("size") == s, _token("window", F.col("at"), s)) for s in range(1, SHINGLE + 1)])
    return placed.withColumn("token", token)


def _occurrences(docs: DataFrame, text: str, tokens: DataFrame, sizes: list[int], first: bool) -> DataFrame:
    """Places of ``tokens`` in the documents; with ``first`` also one row per document, at place -1."""
    split = docs.select("row", "doc_id", words(F.col(text)).alias("w"))
    placed = split.select("*", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    keys = [_token("w", F.col("at"), s) for s in sizes]
    if len(keys) == 1:
        keyed = placed.withColumn("token", F.when(F.col("at") >= 0, keys[0]))
    else:
        none = F.array(F.lit(None).cast("long"))
        keyed = placed.withColumn("token", F.explode(F.when(F.col("at") < 0, none).otherwise(F.array(*keys))))
    known = F.broadcast(tokens.withColumn("known", F.lit(True)))
    met = keyed.join(known, "token", "left").filter(F.col("known") | (F.lit(first) & (F.col("at") < 0)))
    reach = WINDOW - 1
    start = F.greatest(F.col("at") - reach, F.lit(0))
    around = _slice("w", start + 1, F.col("at") + SHINGLE + reach - start)
    return met.select(
        "row",
        F.when(F.col("at") < 0, F.col("doc_id")).alias("doc_id"),
        "at",
        "token",
        F.when(F.col("at") < 0, F.size("w")).alias("n_words"),
        F.when(F.col("at") >= 0, around).alias("around"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", block: int = BLOCK
) -> DataFrame:
    """Per document: row, doc_id, n_words, n_hit and the sorted ``items`` that have windows in it."""
    marked = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", text)
    return _contamination(marked, benchmark, text, item, item_text, block, stored=False)


def _contamination(
    marked: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, block: int, stored: bool
) -> DataFrame:
    """``stored``: the numbers of ``marked`` are written and not made by each scan."""
    found = staged(windows(benchmark, item, item_text), "windows")
    tokens = staged(window_tokens(found.select("window").distinct()), "window-tokens")
    vocabulary = tokens.select("token", "size").distinct()
    # at most SHINGLE rows
    per_size = {r["size"]: r["n"] for r in vocabulary.groupBy("size").agg(F.count("*").alias("n")).collect()}
    sizes = sorted(per_size) or [SHINGLE]
    blocks = max(1, -(-sum(per_size.values()) // block))

    if blocks > 1 and not stored:  # each block scans: files may be split in other places then, so numbers are written
        marked = staged(marked, "numbered")
    parts = []
    for i in range(blocks):
        some = vocabulary.filter(F.pmod(F.xxhash64("token"), F.lit(blocks)) == i).select("token")
        parts.append(staged(_occurrences(marked, text, some, sizes, i == 0), "occurrences"))
    seen = parts[0]
    for part in parts[1:]:
        seen = seen.unionByName(part)

    places = seen.filter("at >= 0").select("row", "at", "token", "around")
    counts = places.groupBy("token").agg(F.count("*").alias("n"))
    # a window whose tokens are not all there cannot occur: only the others need a prefix
    ordered = tokens.join(counts, "token").groupBy("window", "size").agg(
        F.count("*").alias("present"), F.min(F.struct("n", "token", "at")).alias("rarest")
    )
    prefix = ordered.filter(F.col("present") == F.size("window") - F.col("size") + 1).select(
        "window", F.col("rarest.token").alias("token"), F.col("rarest.at").alias("offset")
    )
    start = F.col("at") - F.col("offset")
    inside = F.least(F.col("at"), F.lit(WINDOW - 1)) - F.col("offset")  # of the window within ``around``
    fits = (start >= 0) & (inside >= 0) & (inside + F.size("window") <= F.size("around"))
    hits = places.join(prefix, "token").filter(fits).filter(
        _slice("around", inside + 1, F.size("window")) == F.col("window")
    )
    hits = staged(hits.select("row", "window", start.alias("start"), (start + F.size("window")).alias("end")).distinct(), "hits")

    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("row", "start", "end").distinct().withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = spans.groupBy("row").agg(
        F.sum(F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0))).alias("n_hit")
    )
    # one array per window, so that a window of many items costs a document one row; windows of one passage share their array
    sharing = found.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("sharing"))
    items = hits.select("row", "window").distinct().join(sharing, "window").select("row", "sharing").distinct().groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sharing")))).alias("items")
    )
    documents = seen.filter("at < 0").select("row", "doc_id", F.col("n_words").cast("long"))
    out = documents.join(covered, "row", "left").join(items, "row", "left")
    return out.select(
        "row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contamination_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, stored: bool = False) -> DataFrame:
    """The documents with no hit, found by row numbers (``session.numbered``, which tells what ``stored`` says)."""
    marked = numbered(docs, "numbered", stored)
    named = marked.select("row", "whole.doc_id", "whole.text")
    with scratch() as tables:  # what finds the hits goes when they are written
        hit = _contamination(named, benchmark, "text", "item_id", "text", BLOCK, stored=True).filter("n_hit > 0")
        hit = keep(tables, staged(hit.select("row"), "hit"))
    return marked.join(hit, "row", "left_anti").select("whole.*")


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, array_to_string(w[i:least(i + 9, len(w))], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
