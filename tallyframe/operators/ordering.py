"""Running totals and row positions over a whole table, without one task seeing it all.

The rows are range-partitioned and sorted by Spark, numbered within their partition, and
written once to the shared folder, which fixes the numbers for good. The totals of the
ranges before it, one row per range, then shift each range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import staged

ROWS_PER_RANGE = 500_000
MAX_RANGES = 100_000

_RANGE, _PLACE, _BEFORE = "_range", "_place", "_before_"


def ranges_for(rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    return max(1, min(-(-rows // rows_per_range), MAX_RANGES))


def _ranges(df: DataFrame, rows: int, rows_per_range: int) -> int:
    """As many ranges as the session has shuffle partitions, or more where the rows ask for them."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ranges_for(rows, rows_per_range))


def _ranged(df: DataFrame, order: Sequence[str], ranges: int) -> DataFrame:
    """``df`` as a stored table in ``ranges`` sorted ranges, with range number and place, from 1, in the range."""
    sorted_ranges = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # the id counts the rows of a partition in its lower 33 bits, above them is the partition number
    numbered = sorted_ranges.withColumn("_id", F.monotonically_increasing_id())
    placed = numbered.withColumns(
        {
            _RANGE: F.shiftright("_id", 33).cast("int"),
            _PLACE: F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1,
        }
    )
    return staged(placed.drop("_id"), "ranges")


def _shifted(inside: DataFrame, totals: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add to the totals within a range those of the ranges before it; at most MAX_RANGES rows are broadcast."""
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(_RANGE, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(_BEFORE + n) for n in names])
    return inside.join(F.broadcast(shifts), _RANGE).select(
        *columns, *[(F.col(n) + F.col(_BEFORE + n)).alias(n) for n in names]
    )


def running_sums(
    df: DataFrame, order: Sequence[str], sums: Mapping[str, Column], rows: int, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add, per entry of ``sums``, its total over all rows up to and including this one.

    ``order`` names columns that together are unique. ``rows`` is the number of rows, or more:
    it decides how many ranges there are.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)
    ranged = _ranged(df, order, _ranges(df, rows, rows_per_range))
    window = Window.partitionBy(_RANGE).orderBy(_PLACE).rowsBetween(*upto)
    inside = ranged.select("*", *[F.sum(v).over(window).alias(n) for n, v in sums.items()])
    totals = ranged.groupBy(_RANGE).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    return _shifted(inside, totals, df.columns, list(sums))


def row_position(
    df: DataFrame, order: Sequence[str], rows: int, name: str = "position", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add the row's place, from 1, in the order of ``order``, whose columns together are unique.

    One shuffle: the place within a range is known from the sort.
    """
    ranged = _ranged(df, order, _ranges(df, rows, rows_per_range)).withColumnRenamed(_PLACE, name)
    totals = ranged.groupBy(_RANGE).agg(F.count("*").alias(name))
    return _shifted(ranged, totals, df.columns, [name])
