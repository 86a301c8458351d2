"""Grouping, contingency tables, shares, extents, lookups and joins on mixed-type keys.

No join here carries a hint: Spark broadcasts a side only when its known size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive
execution splits a partition that one key has made too large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, *keys: str, name: str = "counts") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def group_share(df: DataFrame, *keys: str) -> DataFrame:
    """Count and percentage of all rows per group.

    The total is a scalar subquery over the groups, so no window gathers them in one task.
    """
    groups = group_count(df, *keys)
    total = groups.agg(F.sum("counts")).scalar()
    return groups.withColumn("percent", F.col("counts") * 100.0 / total)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Counts of every pair of values; the first column is named ``row_column``.

    Without ``values`` every distinct value of ``column`` becomes a column, ``null`` for NULL. There may be as many as
    ``spark.sql.pivotMaxValues``; more raise an error. For these, name the values or take ``pair_counts``.
    """
    label = F.coalesce(F.col(column).cast("string"), F.lit("null"))
    if values is None:
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = df.select(label.alias("value")).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{column} has more than {most} values (spark.sql.pivotMaxValues): name them, or use pair_counts")
        values = sorted(r[0] for r in found)
    names = [str(v) for v in values]
    table = df.select(F.col(row).alias(f"{row}_{column}"), label.alias("_label")).groupBy(f"{row}_{column}")
    return table.pivot("_label", names).agg(F.count(F.lit(1))).fillna(0, subset=names)


def pair_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """The cells of a contingency table that have rows, one row each, for columns of any number of values; NULL is a value of its own.

    Beside the count of the pair stand those of its row and of its column.
    """
    cells = group_count(df, row, column)
    for side in (row, column):
        sums = cells.groupBy(F.col(side).alias("_side")).agg(F.sum("counts").alias(f"{side}_counts"))
        cells = cells.join(sums, F.col(side).eqNullSafe(F.col("_side"))).drop("_side")
    return cells


def extents(df: DataFrame, *columns: str) -> DataFrame:
    """One row per column: minimum, maximum, mean and spread, from one pass."""
    one = df.agg(
        *[f(c).alias(f"{c}__{n}") for c in columns for n, f in (("lo", F.min), ("hi", F.max), ("avg", F.avg))]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.col(f"{c}__lo").cast("double").alias("lowest"),
                F.col(f"{c}__hi").cast("double").alias("highest"),
                F.col(f"{c}__avg").alias("mean"),
                (F.col(f"{c}__hi") - F.col(f"{c}__lo")).cast("double").alias("spread"),
            )
            for c in columns
        ]
    )
    return one.select(F.inline(rows))


def left_join_numeric_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join of a text key with a whole-number key; both key columns stay.

    Text that is no number matches nothing, leading zeros do not matter.
    """
    u, z = left.alias("udf"), right.alias("zdf")
    return u.join(z, F.col(f"udf.{key}").try_cast("int") == F.col(f"zdf.{key}"), "left_outer")


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str | None = None) -> DataFrame:
    """Inner join with a lookup table. Use ``missing_keys`` first where a gap is an error."""
    table_key = table_key or key
    return df.join(table.withColumnRenamed(table_key, key), key)


def missing_keys(df: DataFrame, table: DataFrame, key: str, table_key: str | None = None) -> DataFrame:
    """Distinct keys of ``df`` that the lookup table lacks."""
    table_key = table_key or key
    return df.select(key).distinct().join(table.select(F.col(table_key).alias(key)), key, "left_anti")


def require_keys(df: DataFrame, table: DataFrame, key: str, table_key: str | None = None) -> None:
    gap = missing_keys(df, table, key, table_key).first()
    if gap is not None:
        raise KeyError(f"{key}={gap[0]!r} has no entry")
