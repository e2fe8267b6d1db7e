"""Helpers the operators share: tables, stored intermediates, Arrow batches, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import scratch_folder

_SHIPPED: set[str] = set()

# White space and words of the contracts: every operator splits on the same six characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, purpose: str, slim: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, lost executors cost nothing.

    ``slim`` rows (ids and counts) are not compressed: a codec's buffers outside the heap, one set per
    file and column, would weigh more than such rows.
    """
    path = scratch_folder(spark, purpose)
    (df.write.option("compression", "uncompressed") if slim else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession, rows: int = 512) -> None:
    """Before Python tasks: Arrow batches small enough for whole, possibly very long texts, and this
    package on the workers, wherever the driver imported it from."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="run-")) / "feedloom.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((root / "feedloom").rglob("*.py")):
                out.write(file, file.relative_to(root))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(rows):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def words(text):
    """Words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def row_key(id_column: str, text_column: str = "text"):
    """Key of a row by id and whole text: equal rows share it, rows without an id and different texts of one
    id do not. A null text is an empty one. Never null."""
    number = F.coalesce(F.concat(F.lit("i"), F.col(id_column).cast("string")), F.lit("n"))
    return F.unhex(F.md5(F.concat(number, F.lit("|"), F.md5(F.coalesce(F.col(text_column), F.lit(""))))))


def let(value, body):
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``edges`` (a, b).

    Alternating large-star and small-star steps; every round is stored in the shared folder, nothing
    of the graph reaches the driver but its size and a checksum. Nodes without an edge have no row.
    """
    def settled(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
            .filter("a != b").distinct()

    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(spark, settled(edges), "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(spark, settled(large), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionAll(least.select("a", F.col("m").alias("b")))
        edges = stored(spark, settled(small), "small-star")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
