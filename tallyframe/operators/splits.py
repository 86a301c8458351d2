"""Dataset splitting: by key hash, at random, by position, and per user."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ordering import ROWS_PER_RANGE, row_position
from tallyframe.session import staged


def key_bucket(*keys: str, buckets: int = 100) -> Column:
    """A bucket from 0 that depends on the key alone, not on file layout or partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def hash_split(df: DataFrame, keys: Sequence[str], parts: Mapping[str, int], name: str = "part") -> DataFrame:
    """Label every row with one of ``parts`` (name to weight), in one pass and with no shuffle."""
    total = sum(parts.values())
    bucket, bound, label = key_bucket(*keys, buckets=total), 0, None
    for part, weight in parts.items():
        bound += weight
        label = F.when(bucket < bound, part) if label is None else label.when(bucket < bound, part)
    return df.withColumn(name, label)


def halves(df: DataFrame, keys: Sequence[str], percent: int) -> tuple[DataFrame, DataFrame]:
    """``percent`` of the rows by key hash, and the others."""
    bucket = key_bucket(*keys)
    return df.filter(bucket < percent), df.filter(bucket >= percent)


#: Buckets per round of ``exact_split``; a 60-bit hash is told apart in at most six rounds of ten bits.
ROUND_BITS, HASH_BITS = 10, 60


def _hash60(keys: Sequence[str]) -> Column:
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _cuts(hashes: DataFrame, ranks: Sequence[int]) -> list[int]:
    """Per rank, from 1, the hash that has it in the rising order of all hashes.

    Every round counts the hashes by their next bits, only within the buckets that hold a rank, so the driver sees
    one number per bucket and no task sees all hashes.
    """
    prefixes, left = [0] * len(ranks), list(ranks)
    for shift in range(HASH_BITS - ROUND_BITS, -1, -ROUND_BITS):
        above = F.shiftright("hash", shift + ROUND_BITS)
        near = hashes.filter(above.isin(*set(prefixes))).groupBy(F.shiftright("hash", shift).alias("bucket")).count()
        counts = sorted((r["bucket"], r["count"]) for r in near.collect())
        for i, prefix in enumerate(prefixes):
            for bucket, n in counts:
                if bucket >> ROUND_BITS != prefix:
                    continue
                if left[i] <= n:
                    prefixes[i] = bucket
                    break
                left[i] -= n
    return prefixes


def exact_split(df: DataFrame, keys: Sequence[str], parts: Mapping[str, int], name: str = "part") -> DataFrame:
    """Label every row with one of ``parts`` (name to weight), with sizes that are exact to the row.

    Rows are taken in the order of their key's hash; the last hash of each part is found by refining a histogram. Rows of
    one key share their hash, so unique keys are what makes the sizes exact; equal hashes stay together.
    """
    hashes = staged(df.select(_hash60(keys).alias("hash")), "hashes")
    rows, total, bound, ends = hashes.count(), sum(parts.values()), 0, []
    for weight in parts.values():
        bound += weight
        ends.append(rows * bound // total)
    inner = sorted({e for e in ends[:-1] if 0 < e <= rows})
    cut = dict(zip(inner, _cuts(hashes, inner)))
    label = F.lit(None).cast("string")
    for part, end in reversed(list(zip(parts, ends))):
        below = _hash60(keys) <= F.lit(cut[end]) if end in cut else F.lit(end > 0)
        label = F.lit(part) if end == rows else F.when(below, part).otherwise(label)
    return df.withColumn(name, label)


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Spark's own split; with a seed it repeats only while the partitioning stays the same."""
    return df.randomSplit([float(w) for w in weights], seed)


def positional_folds(
    df: DataFrame, order: Sequence[str], folds: int = 5, name: str = "fold", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Cut the ordered table into ``folds`` runs of equal length; adds the fold number from 1."""
    rows = df.count()
    size = max(-(-rows // folds), 1)
    placed = row_position(df, order, rows, "_position", rows_per_range)
    return placed.withColumn(name, (F.floor((F.col("_position") - 1) / size) + 1).cast("int")).drop("_position")


def fold_test(folded: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return folded.filter(F.col(name) == fold).drop(name)


def fold_base(folded: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return folded.filter(F.col(name) != fold).drop(name)


def leave_n_out(
    df: DataFrame,
    user: str,
    order: Sequence[str],
    start: int,
    stop: int,
    max_test: int = 0,
    name: str = "held_out",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Mark each user's rows ``start`` to ``stop``, counted in ``order``; the rest is the base.

    With ``max_test`` above 0 only the first so many marked rows, in ``order``, stay marked.
    ``order`` must be unique within the table.

    Only the first ``stop`` rows of a user cross the shuffle of the window (Spark cuts each
    map task's rows to that rank first), and the whole table then meets one interval per
    user, so a user with a large part of all rows is never gathered in one task.
    """
    window = Window.partitionBy(user).orderBy(*order)
    ranked = df.select(user, *order).withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= stop)
    chosen = ranked.filter(F.col("_rank") >= start).drop("_rank")
    if max_test > 0:
        chosen = staged(chosen, "held-out")
        rows = chosen.count()
        placed = row_position(chosen, order, rows, "_at", rows_per_range)
        chosen = placed.filter(F.col("_at") <= max_test).drop("_at")
    key = F.struct(*order)
    spans = chosen.groupBy(user).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    inside = F.coalesce(key.between(F.col("_first"), F.col("_last")), F.lit(False))
    return df.join(spans, user, "left_outer").select(*df.columns, inside.alias(name))
