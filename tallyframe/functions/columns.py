"""Column functions: cleaning, casting, code lookup, derived values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Descriptions attached to the codes in the reports.
PAGE_KINDS = {0: "暂时性网页(ephemeral)", 1: "长青网页(evergreen)"}
SEASONS = {1: "春", 2: "夏", 3: "秋", 4: "冬"}
HOLIDAYS = {0: "非假日", 1: "假日"}
WEEKDAYS = {0: "一", 1: "二", 2: "三", 3: "四", 4: "五", 5: "六", 6: "日"}
WORKING_DAYS = {0: "非工作日", 1: "工作日"}
WEATHER = {1: "晴", 2: "阴", 3: "小雨", 4: "大雨"}

# Names of the first cover-type fields in the report.
COVER_NAMES = {"f0": "海拔", "f1": "方位", "f2": "斜率", "f3": "垂直距离", "f4": "水平距离", "f5": "9点时阴影"}

# What the normalised weather readings were divided by.
READING_MAXIMA = {"temp": 41.0, "atemp": 50.0, "hum": 100.0, "windspeed": 67.0}


def missing_to_zero(column: str | Column, token: str = "?", lenient: bool = False) -> Column:
    """The column as double, the missing token as 0.

    Other non-numeric text raises; with ``lenient`` it becomes NULL.
    """
    c = F.col(column) if isinstance(column, str) else column
    cleaned = F.when(c == token, F.lit("0")).otherwise(c)
    return cleaned.try_cast("double") if lenient else cleaned.cast("double")


def clamp_nonnegative(column: str | Column) -> Column:
    """Negative values as 0, NULL kept."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def cast_columns(df: DataFrame, names: Sequence[str], to: str = "double") -> DataFrame:
    """``names`` cast in one projection; the other columns keep type and place."""
    wanted = set(names)
    return df.select([F.col(c).cast(to).alias(c) if c in wanted else F.col(c) for c in df.columns])


def clean_numeric(df: DataFrame, names: Sequence[str], lenient: bool = False) -> DataFrame:
    """``missing_to_zero`` over many columns in one projection."""
    wanted = set(names)
    return df.select(
        [missing_to_zero(c, lenient=lenient).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def birth_year(age: str | Column, year: int) -> Column:
    c = F.col(age) if isinstance(age, str) else age
    return F.lit(year) - c


def shift_label(column: str | Column, by: int = 1) -> Column:
    """Class numbers that start at ``by`` as class numbers that start at 0."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("double") - F.lit(float(by))


def code_to_text(column: str | Column, texts: Mapping[int, str]) -> Column:
    """Look a numeric code up in a fixed mapping; NULL where it has no text."""
    c = F.col(column) if isinstance(column, str) else column
    pairs = [F.lit(x) for code, text in texts.items() for x in (code, text)]
    return F.try_element_at(F.create_map(*pairs), c.cast("int"))


def denormalise(column: str | Column, maximum: float) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c * F.lit(maximum)


def absolute_error(label: str, prediction: str) -> Column:
    """Distance of the label from the prediction cut to a whole number."""
    return F.abs(F.col(label) - F.col(prediction).cast("long"))


def is_hit(label: str, prediction: str) -> Column:
    return F.col(label) == F.col(prediction).cast("long")
