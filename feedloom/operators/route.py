"""Split transformed rows into accepted and rejected ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rules import ACCEPTED


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("_ROW_STATUS") == ACCEPTED)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("_ROW_STATUS") != ACCEPTED)


def failure_text(rows: DataFrame) -> DataFrame:
    """Failures as one text: ``type#source#desc`` joined by ``;``."""
    return rows.withColumn("_ROW_EXCEPTIONS", F.expr(
        "concat_ws(';', transform(_ROW_EXCEPTIONS, x -> concat_ws('#', x.type, x.source, x.desc)))"))
