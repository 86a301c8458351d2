"""Mixing sources to target weights by hash-threshold histograms.

A document's size is its number of words. Every source gets a target; its documents are
taken whole as often as the target holds the source, and the rest of the target, the
budget, is met by the documents whose hash is below a threshold. The threshold comes from
sizes summed by source and hash bucket: the bucket in which the budget runs out is cut into
finer buckets, and only that one, until it holds a single hash. Nothing is sorted; the
histograms have ``2**BITS`` buckets per source and step.

The document at the threshold is taken if that brings the source nearer to its target.
Null texts have size 0. Null is a source of its own, after all others. The hash is of the
``doc_id`` (null: the empty text), so equal ids are taken together and reruns agree. Sources
without words have target 0. Other columns pass through; the added ones replace columns of
the same name.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import staged

#: Fixed values of the mix: weights by source in turn, the share of all words, the limit per source.
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
LIMIT = 2

HASH_BITS, BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(doc_id: str = "doc_id") -> Column:
    """60 bits that depend on the id alone."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: list[tuple[str | None, int]]) -> list[tuple[str | None, int, Fraction]]:
    """Per source, in order: its size and target. Sources are few; their sums come from a group-by."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(ordered))]
    target = [Fraction(0)] * len(ordered)
    left = SHARE * sum(n for _, n in ordered)
    free = {i for i, (_, n) in enumerate(ordered) if n}
    while free:
        total = sum(weight[i] for i in free)
        over = {i for i in free if left * weight[i] > LIMIT * ordered[i][1] * total}
        if not over:
            for i in free:
                target[i] = left * weight[i] / total
            break
        for i in over:
            target[i] = Fraction(LIMIT * ordered[i][1])
            left -= target[i]
        free -= over
    return [(s, n, t) for (s, n), t in zip(ordered, target, strict=True)]


def thresholds(slim: DataFrame, budgets: dict[str | None, Fraction]) -> dict[str | None, int]:
    """Per source the largest hash that is taken, -1 for none.

    ``slim`` has source, size and place, and is read once per step of ``BITS`` bits.
    """
    spark = slim.sparkSession
    known, taken = {s: 0 for s in budgets}, {s: Fraction(0) for s in budgets}
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("known", T.LongType())])
    for done in range(0, HASH_BITS, BITS):
        shift = HASH_BITS - done - BITS
        above = F.shiftright("place", shift + BITS)
        inside = F.broadcast(spark.createDataFrame(list(known.items()), schema))  # one row per source
        rest = slim.withColumnRenamed("source", "s").join(inside, F.col("s").eqNullSafe(F.col("source")) & (above == F.col("known")))
        rows = rest.groupBy("s", F.shiftright("place", shift).alias("bucket")).agg(F.sum("size").alias("size")).collect()
        sums: dict[str | None, list[tuple[int, int]]] = {s: [] for s in budgets}
        for r in rows:  # at most 2**BITS per source
            sums[r["s"]].append((r["bucket"], r["size"]))
        for s, found in sums.items():
            # if the budget never runs out, all of the range is taken
            known[s] = (known[s] << BITS) + (1 << BITS) - 1
            for bucket, size in sorted(found):
                if taken[s] + size > budgets[s]:
                    known[s] = bucket
                    if done + BITS == HASH_BITS and 2 * (budgets[s] - taken[s]) <= size:
                        known[s] -= 1  # the single hash at the threshold would miss by more
                    break
                taken[s] += size
    return known


def mixed(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Add size, source_size, target and taken (words that the mix takes, repeats counted)."""
    sized = docs.withColumns({"size": word_count(F.col(text))})
    slim = staged(sized.select(F.col(source).alias("source"), "size", place().alias("place")), "sizes")
    rows = slim.groupBy("source").agg(F.sum("size").alias("size")).collect()  # one row per source
    goal = targets([(r["source"], r["size"]) for r in rows])
    whole = {s: int(t // n) if n else 0 for s, n, t in goal}
    upto = thresholds(slim, {s: t - whole[s] * n for s, n, t in goal}) if goal else {}
    plan = docs.sparkSession.createDataFrame(
        [(s, n, float(t), whole[s], upto[s]) for s, n, t in goal],
        "_source string, source_size long, target double, _whole int, _upto long",
    )
    kept = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "taken")]
    joined = docs.select(*kept, word_count(F.col(text)).alias("size")).join(
        F.broadcast(plan), F.col(source).eqNullSafe(F.col("_source")), "left"  # one row per source
    )
    more = F.when(place() <= F.col("_upto"), 1).otherwise(0)
    times = (F.col("_whole") + more).cast("int")
    return joined.select(
        *kept, "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("_times")
    )


def mixing_query(docs: DataFrame) -> DataFrame:
    return mixed(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def take_mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns they had whatever their names."""
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("whole"))
    chosen = mixed(packed).filter("_times > 0")
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("whole.*")


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i
  FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (i - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sums),
-- a source stops at twice its size in the order of weight over size: water filling
ranked AS (
  SELECT *, sum(2 * source_size) OVER w AS full_upto, sum(weight) OVER v AS weight_from,
         (SELECT 1.5::DOUBLE * sum(source_size) FROM sums) AS total, row_number() OVER w AS r
  FROM weighed WHERE source_size > 0
  WINDOW w AS (ORDER BY source_size * 1.0 / weight, i), v AS (ORDER BY source_size * 1.0 / weight DESC, i DESC)),
stops AS (
  SELECT *, (total - (full_upto - 2 * source_size)) * weight / weight_from > 2 * source_size AS stopped FROM ranked),
level AS (
  SELECT max(total) - coalesce(sum(2 * source_size) FILTER (stopped), 0)::DOUBLE AS rest,
         sum(weight) FILTER (NOT stopped)::DOUBLE AS weights
  FROM stops),
goals AS (
  SELECT w.source, w.source_size,
         CASE WHEN w.source_size = 0 THEN 0.0 WHEN s.stopped THEN 2.0 * w.source_size ELSE rest * w.weight / weights END::DOUBLE AS target
  FROM weighed w LEFT JOIN stops s ON w.i = s.i, level),
running AS (
  SELECT z.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END::BIGINT AS whole,
         sum(z.size) OVER (PARTITION BY z.source ORDER BY z.place) AS upto,
         sum(z.size) OVER (PARTITION BY z.source ORDER BY z.place) - sum(z.size) OVER (PARTITION BY z.source, z.place) AS before
  FROM sized z JOIN goals g ON z.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= target - whole * source_size THEN 1
                             WHEN before <= target - whole * source_size
                                  AND 2 * (target - whole * source_size - before) > upto - before THEN 1
                             ELSE 0 END))::BIGINT AS taken
FROM running"""
