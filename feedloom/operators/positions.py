"""Line numbers over many files without moving a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_folder


def line_numbers(lines: DataFrame) -> DataFrame:
    """Add ``_LINE_NO``, counted from 1 over all files: by folder, then by the number in the name of a
    part file (``part-100000`` comes after ``part-99999``), then by name.

    The row ids of a block follow one another, so a line's place is its id less the first of its
    block. Only one row per block, with that id and the lines before the block, is gathered and
    stored; Spark broadcasts that table when its size allows it.
    """
    spark = lines.sparkSession
    block = ["_FILE", "_BLOCK"]
    number = F.expr("try_cast(regexp_extract(_FILE, '/part-([0-9]+)[^/]*$', 1) AS BIGINT)")
    order = Window.orderBy(F.regexp_extract("_FILE", "^(.*/)", 1), number.asc_nulls_first(), *block)
    before = F.sum("_LINES").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("_LINES"), F.min("_ROW_ID").alias("_FIRST"))
    blocks = first.select(*block, (F.coalesce(before, F.lit(0)) - F.col("_FIRST") + 1).alias("_SHIFT"))
    folder = scratch_folder(spark, "blocks")
    blocks.write.parquet(folder)
    blocks = spark.read.schema(blocks.schema).parquet(folder)
    return lines.join(blocks, block).select(*lines.columns, (F.col("_ROW_ID") + F.col("_SHIFT")).alias("_LINE_NO"))
