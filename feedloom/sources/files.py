"""File listings as tables. Only names, sizes and times are read, never the content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import base_name, sized_name


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``key, size_bytes, modified`` of the files below a folder; ``_``-names are skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.col("path").alias("key"), F.col("length").alias("size_bytes"),
                        F.col("modificationTime").alias("modified")) \
        .where(~F.startswith(base_name(F.col("key")), F.lit("_")))


def single_data_file(files: DataFrame) -> DataFrame:
    """The one data file of an output folder; ``part-`` files are preferred over others."""
    is_part = F.startswith(base_name(F.col("key")), F.lit("part-"))
    parts, others = files.agg(F.count_if(is_part), F.count_if(~is_part)).first()
    found = parts or others
    if found == 0:
        raise FileNotFoundError("no data file in the folder")
    if found > 1:
        raise RuntimeError(f"expected one data file, found {found}")
    return files.where(is_part) if parts else files


def manifest(files: DataFrame) -> DataFrame:
    return files.select(F.col("key").alias("original_key"),
                        sized_name(F.col("key"), F.col("size_bytes")).alias("new_name"),
                        "size_bytes")
