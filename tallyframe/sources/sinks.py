"""Text and model sinks that leave existing output alone."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def write_lines(df: DataFrame, path: str, columns: Sequence[str | Column], sep: str = "\t") -> None:
    """One line per row; raises when ``path`` exists."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    df.select(F.concat_ws(sep, *parts).alias("value")).write.mode("errorifexists").text(path)


def write_delimited(df: DataFrame, path: str, sep: str, header: bool = False, quote_all: bool = False) -> None:
    """CSV sink; raises when ``path`` exists."""
    writer = df.write.mode("errorifexists").option("sep", sep).option("header", header)
    writer.option("quoteAll", quote_all).csv(path)


def write_lines_once(df: DataFrame, path: str, columns: Sequence[str | Column], sep: str = "\t") -> bool:
    """Like ``write_lines``, but existing output is reported and kept; True when written."""
    try:
        write_lines(df, path, columns, sep)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        log.warning("kept the output that is already at %s", path)
        return False
    return True


def save_model_once(model, path: str) -> bool:
    """Save an ML model; an existing one is reported and kept; True when saved."""
    try:
        model.write().save(path)
    except Exception as error:  # the kind differs between local and Hadoop file systems
        if "already exists" not in str(error):
            raise
        log.warning("kept the model that is already at %s", path)
        return False
    return True
