"""Lookup and metadata tables: constants, pipe-delimited files, catalog tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.lookups import KEY, VALUE

FILE_METADATA = ("ROW_TYPE_NO INT, ROW_TYPE STRING, FIELDS_IN BIGINT, FIELDS_OUT BIGINT, "
                 "TRANSFORMS BIGINT")
EXCEPTION_METADATA = "EXCEPTION_TYPE STRING, EXCEPTION_CATEGORY STRING"
REPORT_TEMPLATE = ("REPORT_LINE_NO INT, REPORT_SECTION_NO INT, REPORT_SECTION STRING, "
                   "REPORT_LEVEL STRING, REPORT_LINE_LABEL STRING, REPORT_RESULT_LABEL STRING")


def read_pipe_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Pipe-delimited text with a header, under an explicit schema."""
    return spark.read.schema(schema).option("header", True).option("sep", "|") \
        .option("enforceSchema", True).csv(path)


def headers(spark: SparkSession, path: str | list[str], sep: str = "|") -> dict[tuple[str, ...], list[str]]:
    """Files of a pipe-delimited source grouped by their header, each header read once (one small job)."""
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header")).collect()
    grouped: dict[tuple[str, ...], list[str]] = {}
    for row in first:
        names = tuple(c.strip().strip('"') for c in (row.header or "").rstrip("\r").split(sep))
        grouped.setdefault(names, []).append(row.file)
    return grouped


def read_by_name(spark: SparkSession, path: str | list[str], schema: str, sep: str = "|") -> DataFrame:
    """Pipe-delimited files with headers, columns bound by name: every file may order them as it likes.

    A column of ``schema`` that a file lacks is null (of its type) in that file's rows; names are compared
    without regard to case. A header with a name that ``schema`` lacks, or with a name twice, is an error
    that names the file and the columns: a silently dropped or doubled column would change every count
    made from the table. Cells are read as text and cast to the types of ``schema`` (ANSI: a cell that is
    no number is an error). An empty source gives an empty table.
    """
    wanted = StructType.fromDDL(schema)
    known = {f.name.upper(): f for f in wanted.fields}
    parts = []
    for names, files in sorted(headers(spark, path, sep).items()):
        upper = [n.upper() for n in names]
        unknown = sorted({n for n in names if n.upper() not in known})
        twice = sorted({n for n in names if upper.count(n.upper()) > 1})
        if unknown or twice:
            raise ValueError(f"{files[0]}: columns not in the schema {unknown}, columns given twice {twice}")
        raw = spark.read.schema(", ".join(f"`_C{i}` STRING" for i in range(len(names)))) \
            .option("header", True).option("sep", sep).option("enforceSchema", True).csv(files)
        at = {n: i for i, n in enumerate(upper)}
        parts.append(raw.select(*[
            (F.col(f"_C{at[f.name.upper()]}") if f.name.upper() in at else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted.fields]))
    if not parts:
        return spark.createDataFrame([], wanted)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def local_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A few constant rows as a local relation: no job, and its exact size is known to the planner."""
    columns = list(zip(*rows)) if rows else []
    typed = to_arrow_schema(StructType.fromDDL(schema))
    arrays = [pa.array(columns[i] if rows else [], f.type) for i, f in enumerate(typed)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=typed), schema)


def pipe_text(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """The same format from a constant."""
    types = [c.split()[-1] for c in schema.split(", ")]
    rows = []
    for record in text.splitlines()[1:]:
        cells = [c or None for c in record.split("|")]
        rows.append([c if c is None or t == "STRING" else int(c) for c, t in zip(cells, types)])
    return local_table(spark, rows, schema)


def constant_lookup(spark: SparkSession, values: dict[str, str | None]) -> DataFrame:
    return local_table(spark, list(values.items()), f"{KEY} STRING, {VALUE} STRING")


def unique_lookup(table: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Key and value of a two-column table, one row per key; null keys match nothing.

    Of several rows with one key the last in ``order`` counts, without an order the last as read:
    give an order for tables that are no plain scan.
    """
    key, value = table.columns[:2]
    place = [F.col(c) for c in order] or [F.monotonically_increasing_id()]
    last = F.struct(*(c.alias(f"_AT_{i}") for i, c in enumerate(place)), F.col(value).cast("string").alias("_LAST_VALUE"))
    return (table.select(F.col(key).cast("string").alias(KEY), last.alias("_LAST"))
            .where(F.col(KEY).isNotNull())
            .groupBy(KEY).agg(F.max("_LAST").getField("_LAST_VALUE").alias(VALUE)))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Two-column pipe-delimited lookup file; an empty value is null and counts as a miss.

    Of equal keys the last line counts, of several files that of the last file by name.
    """
    rows = read_pipe_csv(spark, path, "_FILE_KEY STRING, _FILE_VALUE STRING").select(
        "*", F.col("_metadata.file_path").alias("_AT_FILE"), F.col("_metadata.file_block_start").alias("_AT_BLOCK"),
        F.monotonically_increasing_id().alias("_AT_ROW"))
    return unique_lookup(rows, ("_AT_FILE", "_AT_BLOCK", "_AT_ROW"))


def read_table_lookup(spark: SparkSession, name: str) -> DataFrame:
    return unique_lookup(spark.table(name))
