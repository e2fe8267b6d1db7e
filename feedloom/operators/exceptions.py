"""One row per rule failure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .route import rejected

EXCEPTION_COLUMNS = ("_ROW_ID", "_ROW_TYPE", "_EXCEPTION_TYPE", "_EXCEPTION_SOURCE",
                     "_EXCEPTION_DESC")


def exception_rows(rows: DataFrame) -> DataFrame:
    """Failures of rejected rows in rule order; the row order is kept.

    A rejected row has at least one failure, so ``explode_outer`` gives what ``explode`` would,
    without the filter on the list that would make Spark build every list twice.
    """
    origin = [c for c in rows.columns if c in ("_FILE", "_BLOCK")]
    return rejected(rows).select(
        *origin, "_ROW_ID", "_ROW_TYPE", F.explode_outer("_ROW_EXCEPTIONS").alias("x")).select(
        *origin, "_ROW_ID", "_ROW_TYPE",
        F.col("x.type").alias("_EXCEPTION_TYPE"),
        F.col("x.source").alias("_EXCEPTION_SOURCE"),
        F.col("x.desc").alias("_EXCEPTION_DESC"))


def split_failure_text(rows: DataFrame, column: str = "_ROW_EXCEPTION") -> DataFrame:
    """The same from failures kept as ``type#source#desc`` text; a ``#`` in the data stays in desc."""
    parts = F.split(column, "#", 3)
    return rows.select("_ROW_ID", "_ROW_TYPE",
                       F.get(parts, 0).alias("_EXCEPTION_TYPE"),
                       F.get(parts, 1).alias("_EXCEPTION_SOURCE"),
                       F.get(parts, 2).alias("_EXCEPTION_DESC"))
