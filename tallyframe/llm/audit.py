"""How five text filters interact: what each removes in every order, counted from one mask per document.

Four filters look at one text alone and are computed in a single scan, which keeps an id, a part, a mask
and a 64-bit hash per document. The fifth removes a text that a smaller id has too. For it, a
counting Bloom sketch is summed over the hashes: every task adds up its own counters, the shuffle
merges them, and only cells counted twice or more are kept. A document with a cell below two is surely
unique; the others alone send their text into the shuffle, where equal full texts meet and keep
their smallest id. Equal texts are combined in the scan's tasks, so a text that a third of all
documents share arrives once per task. A hash that turns out to stand for several texts decides nothing: its
documents are looked up by their full text.

The flags then give counts per part, mask and label, at most 128 rows per part, from which every
order, step and Shapley share is a sum.

The sketch has ``CELLS_PER_DOCUMENT`` cells per document at every size. The kept cells are written,
and Spark broadcasts them if their files are small, else it joins by shuffling.

Null texts are empty, null and empty parts are one part ``''``. A document without id is no copy and has no
label; rows that repeat id and text aren't copies of each other. Of several label rows of one id, any that
marks the document counts. A word is a maximal run of other characters than space and tab to carriage return;
texts of any length are measured whole. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import staged

FILTERS = "ABCDE"
CELLS_PER_DOCUMENT, SEEDS = 16, (11, 12)
#: Copies of the smaller side of a join, over which a frequent key is dealt.
SALTS = 8

_GAPS = r"[\x20\x09-\x0D]+"
_REPEATED = 1 << FILTERS.index("E")


def failing(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, _GAPS, -1), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    tests = [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def _cells(hashed: Column, cells: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), hashed), F.lit(cells)) for seed in SEEDS]


def filled_cells(hashes: DataFrame, cells: int) -> DataFrame:
    """The cells of the sketch that at least two hashes of the column ``h`` fall into, each hash counted as often as it occurs."""
    hit = hashes.select(F.explode(F.array_distinct(F.array(*_cells(F.col("h"), cells)))).alias("cell"))
    return hit.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") >= 2).select("cell")


def possible_repeats(documents: DataFrame, filled: DataFrame, cells: int) -> DataFrame:
    """Rows (h, ...) all of whose cells are filled."""
    kept = documents
    for cell in _cells(F.col("h"), cells):
        kept = kept.withColumn("cell", cell).join(filled, "cell", "left_semi").drop("cell")
    return kept


def _salted(rows: DataFrame, small: DataFrame, key: str, salt: Column, how: str) -> DataFrame:
    """Join on ``key``, the rows of one key dealt over ``SALTS`` parts.

    The copies are merged: Spark takes them for as small as the stored rows they are made from, and would build them in the driver.
    """
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    return rows.withColumn("salt", F.pmod(salt, F.lit(SALTS))).join(copies.hint("merge"), [key, "salt"], how).drop("salt")


def masks(documents: DataFrame, hashing=text_hash) -> DataFrame:
    """doc_id, part, mask of all five filters (bit 0 for A), and how many documents have them."""
    text = F.coalesce("text", F.lit(""))
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")
    ).withColumn("h", hashing(F.col("text")))
    flags = staged(texts.select("doc_id", "part", "h", failing(F.col("text")).alias("mask")), "flags")
    rows = max(1, flags.count())
    cells = 1 << (CELLS_PER_DOCUMENT * rows - 1).bit_length()
    filled = staged(filled_cells(flags.select("h"), cells), "sketch")

    # equal full texts meet; each keeps its smallest id
    suspects = possible_repeats(texts.select("doc_id", "h", "text"), filled, cells)
    firsts = staged(suspects.groupBy("h", "text").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "firsts")
    hashed = staged(
        firsts.groupBy("h").agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n")), "hashes"
    )
    counted = flags.groupBy("doc_id", "part", "h", "mask").agg(F.count("*").alias("documents"))
    known = hashed.filter((F.col("texts") > 1) | (F.col("n") > 1)).select("h", "texts", "first")
    joined = _salted(counted, known, "h", F.xxhash64("doc_id"), "left")
    copy = F.when(F.col("doc_id") > F.col("first"), _REPEATED).otherwise(0)
    out = ["doc_id", "part", (F.col("mask") + copy).alias("mask"), "documents"]
    sure = joined.filter(F.coalesce("texts", F.lit(1)) == 1).select(*out)
    shared = known.filter(F.col("texts") > 1).select("h")
    if shared.isEmpty():
        return sure
    again = texts.join(shared, "h", "left_semi").join(firsts.select("h", "text", "first").hint("merge"), ["h", "text"])
    unsure = again.withColumns({"mask": failing(F.col("text")), "documents": F.lit(1).cast("long")}).select(*out)
    return sure.unionByName(unsure)


def mask_counts(documents: DataFrame, labels: DataFrame, hashing=text_hash) -> DataFrame:
    """part, mask, documents, good, toxic: how many documents fail exactly the filters of the mask, and how many of them are labelled so."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"),
    )
    found = _salted(masks(documents, hashing), known, "doc_id", F.xxhash64("mask", "part"), "left")
    return found.groupBy("part", "mask").agg(
        F.sum("documents").alias("documents"),
        F.sum(F.when(F.col("is_good"), F.col("documents")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("documents")).otherwise(0)).alias("toxic"),
    )


def interactions(counts: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what the step keeps, removes and loses."""
    steps, shares = [], 1
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            steps.append(f"named_struct('filter_order', '{''.join(order)}', 'step', {step}, 'bit', {bit}, 'before', {before})")
            before |= bit
        shares = max(shares, len(order))
    orders = len(steps) // shares
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    each = counts.withColumn("at", F.explode(F.expr(f"array({', '.join(steps)})"))).select("*", "at.*")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(condition: Column, value: str | Column = "documents") -> Column:
        return F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value).otherwise(0)).cast("long")

    # of all orders, an equal share has this filter first among those that the document fails
    share = F.col("documents") * (F.lit(orders) / F.greatest(F.bit_count(mask), F.lit(1))).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit_query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(mask_counts(documents, labels))


AUDIT_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM words GROUP BY text),
marks AS (
    SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
fails AS (
    SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e,
           coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM words JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
failed AS (
    SELECT part, good, toxic, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END,
           CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS f, count(*) AS n
    FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
    SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
met AS (
    SELECT part, filter_order, step, letter, f, n, good, toxic, contains(f, letter) AS hit,
           length(translate(f, before, '')) < length(f) AS gone FROM failed, steps),
summed AS (
    SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS kept,
           coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant,
           coalesce(sum(n) FILTER (f = letter), 0) AS unique_fails,
           coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0) AS good_lost,
           coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INT) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed"""
