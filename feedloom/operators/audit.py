"""Reconciliation: counts of a run, joined to metadata, as a long and a tabular report.

Everything is derived from one small tally, so the data is read once. Metadata tables are joined
without a hint: Spark broadcasts them by their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..layouts.model import BLANK, JOINED, PLAIN, UNRECOGNIZED, Feed
from ..layouts.reports import RESULT_LABELS
from ..sources.tables import FILE_METADATA, local_table
from .rules import ACCEPTED

FILE = "<file>"
WEIGHTED = ("ROWS_OUT", "FIELDS_IN", "FIELDS_OUT", "TRANSFORMS")


def layout_metadata(spark: SparkSession, feed: Feed) -> DataFrame:
    """File metadata counted from the layout, for feeds that come without a metadata file."""
    rows = []
    for i, t in enumerate(feed.types, 1):
        read = sum(f.rule != JOINED for f in t.fields)
        changed = sum(f.rule not in (PLAIN, BLANK) for f in t.fields)
        rows.append((i, t.name, read or 1, len(t.rendered) or 1, changed))
    rows.append((len(rows) + 1, UNRECOGNIZED, 0, 0, 0))
    return local_table(spark, rows, FILE_METADATA)


TALLY = "_ROW_TYPE STRING, _ROW_STATUS INT, _FAILURES ARRAY<STRING>, _ROWS BIGINT"


def tally(rows: DataFrame) -> DataFrame:
    """Rows per type, status and list of failure types: the only pass over the data.

    Combined on the map side; the result has at most a few hundred rows per record type. ``rows`` of
    ``outcomes`` already carry the types alone.
    """
    failed = F.col("_FAILURES") if "_FAILURES" in rows.columns else F.col("_ROW_EXCEPTIONS.type").alias("_FAILURES")
    return rows.groupBy("_ROW_TYPE", "_ROW_STATUS", failed).agg(F.count(F.lit(1)).alias("_ROWS"))


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("count"))


def type_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_ROW_TYPE").count()


def total(counts: DataFrame) -> DataFrame:
    """Sum of counts; null if there are none."""
    return counts.agg(F.sum("count").alias("count"))


def routed_counts(rows: DataFrame) -> DataFrame:
    """Rows in, out and rejected, per type and for the file: one conditional aggregation."""
    ok = F.col("_ROW_STATUS") == ACCEPTED
    per_type = rows.groupBy("_ROW_TYPE").agg(F.count(F.lit(1)).alias("ROWS_IN"),
                                             F.count_if(ok).alias("ROWS_OUT"),
                                             F.count_if(~ok).alias("ROWS_REJECTED"))
    return (per_type.unpivot("_ROW_TYPE", ["ROWS_IN", "ROWS_OUT", "ROWS_REJECTED"], "section", "count")
            .where(F.col("count") > 0)
            .select("section", F.explode(F.array("_ROW_TYPE", F.lit(FILE))).alias("_ROW_TYPE"), "count")
            .groupBy("section", "_ROW_TYPE").agg(F.sum("count").alias("count")))


def with_file_metadata(counts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Counts of the types named in the metadata."""
    return counts.join(metadata, F.col("_ROW_TYPE") == F.col("ROW_TYPE"), "inner")


def weighted_counts(counts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows out, and fields and transforms those rows amount to, one row per measure."""
    return (with_file_metadata(counts, metadata)
            .select("_ROW_TYPE", F.col("count").alias("ROWS_OUT"),
                    *((F.col("count") * F.col(c)).alias(c) for c in WEIGHTED[1:]))
            .unpivot("_ROW_TYPE", list(WEIGHTED), "_REPORT_SECTION", "_REPORT_RESULT_VALUE"))


def category_counts(exceptions: DataFrame, categories: DataFrame, weight: str | None = None) -> DataFrame:
    """Exceptions per row type and category; types without a category are left out."""
    counted = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (exceptions.join(categories,
                            F.col("_EXCEPTION_TYPE") == F.col("EXCEPTION_TYPE"), "inner")
            .groupBy("_ROW_TYPE", "EXCEPTION_CATEGORY").agg(counted.alias("count")))


def _values(df: DataFrame, section, level: str, row_type, value) -> DataFrame:
    return df.select(section.alias("_REPORT_SECTION"), F.lit(level).alias("_REPORT_LEVEL"),
                     row_type.alias("_ROW_TYPE"), F.lit(None).cast("string").alias("_REPORT_LINE_LABEL"),
                     value.cast("bigint").alias("_REPORT_RESULT_VALUE"))


def audit_values(counted: DataFrame, metadata: DataFrame, categories: DataFrame,
                 complete: bool = False) -> DataFrame:
    """All result values of the audit from the tally, which is read once.

    Every tally row is spread over the values it counts towards, and the values are summed up.
    ``complete`` adds the values the report template has lines for but nothing ever fills: rows not
    transformed, rows not output, and rows in per type.
    """
    def value(section: str, level: str, n: str = "_ROWS") -> str:
        row_type = f"'{FILE}'" if level == "FILE" else "_ROW_TYPE"
        return (f"named_struct('section', '{section}', 'level', '{level}', 'row_type', {row_type}, "
                f"'exception', cast(null AS string), 'n', {n})")

    kept = [value("ROWS_OUT", "FILE"), value("ROWS_TRANSFORMED", "FILE")]
    named = [value("ROWS_TRANSFORMED", "ROW_TYPE"), value("ROWS_OUT", "ROW_TYPE")] + [
        value(m, "ROW_TYPE", f"_ROWS * {m}") for m in WEIGHTED[1:]]
    refused = [value("ROWS_REJECTED", "FILE"), value("ROWS_REJECTED", "ROW_TYPE")]
    every = [value("ROWS_IN", "FILE")]
    if complete:
        refused += [value("ROWS_NOT_TRANSFORMED", "FILE"), value("ROWS_NOT_OUT", "FILE")]
        every += [value("ROWS_IN", "ROW_TYPE")]
    failed = ("transform(_FAILURES, x -> named_struct('section', cast(null AS string), 'level', 'ROW_TYPE', "
              "'row_type', _ROW_TYPE, 'exception', x, 'n', _ROWS))")
    # a tally row without a type counts missing lines: they came in, and that is all
    spread = (f"inline(CASE WHEN _ROW_TYPE IS NULL THEN array({every[0]}) WHEN _ROW_STATUS <> {ACCEPTED} THEN concat(array({', '.join(every + refused)}), {failed})"
              f" WHEN ROW_TYPE IS NULL THEN array({', '.join(every + kept)})"
              f" ELSE array({', '.join(every + kept + named)}) END)")

    weights = metadata.select("ROW_TYPE", *WEIGHTED[1:])
    category = F.coalesce("section", "EXCEPTION_CATEGORY")
    # a file without any row still reports its totals
    totals = [("ROWS_IN", 0), ("ROWS_OUT", None), ("ROWS_REJECTED", None), ("ROWS_TRANSFORMED", None)]
    none = local_table(counted.sparkSession, [(s, "FILE", FILE, n) for s, n in totals],
                       "_REPORT_SECTION STRING, _REPORT_LEVEL STRING, _ROW_TYPE STRING, n BIGINT")
    return (counted.join(weights, F.col("_ROW_TYPE") == F.col("ROW_TYPE"), "left")
            .selectExpr(spread)
            .join(categories, F.col("exception") == F.col("EXCEPTION_TYPE"), "left")
            .where(category.isNotNull())
            .select(category.alias("_REPORT_SECTION"), F.col("level").alias("_REPORT_LEVEL"),
                    F.col("row_type").alias("_ROW_TYPE"), "n")
            .unionByName(none)
            .groupBy("_REPORT_SECTION", "_REPORT_LEVEL", "_ROW_TYPE")
            .agg(F.sum("n").alias("_REPORT_RESULT_VALUE"))
            .select("_REPORT_SECTION", "_REPORT_LEVEL", "_ROW_TYPE",
                    F.lit(None).cast("string").alias("_REPORT_LINE_LABEL"), "_REPORT_RESULT_VALUE"))


def filled_report(values: DataFrame, template: DataFrame, metadata: DataFrame, file_name: str) -> DataFrame:
    """The template's lines with their values, null where there is none.

    A line for the file stands once, a line for record types once per type of the metadata. There are
    at most as many values as sections times record types, so they are broadcast to the lines.
    """
    for_types = F.col("REPORT_LEVEL") == "ROW_TYPE"
    types = F.broadcast(metadata.select(F.lit("ROW_TYPE").alias("_LEVEL"), F.col("ROW_TYPE_NO").alias("_NO"),
                                        F.col("ROW_TYPE").alias("_NAME")))
    per_type = template.where(for_types).join(types, F.col("REPORT_LEVEL") == F.col("_LEVEL"), "left").drop("_LEVEL")
    once = template.where(~for_types).withColumns({"_NO": F.lit(0), "_NAME": F.lit(FILE)})
    lines = once.unionByName(per_type).withColumns(
        {"ROW_TYPE_NO": F.coalesce("_NO", F.lit(0)), "ROW_TYPE": F.coalesce("_NAME", F.lit(FILE))})
    keyed = values.select(F.concat_ws("\n", "_REPORT_SECTION", "_REPORT_LEVEL", "_ROW_TYPE").alias("_KEY"),
                          "_REPORT_RESULT_VALUE")
    wanted = F.concat_ws("\n", "REPORT_SECTION", "REPORT_LEVEL", "ROW_TYPE")
    return lines.withColumn("_WANTED", wanted).join(F.broadcast(keyed), F.col("_WANTED") == F.col("_KEY"), "left").select(
        "REPORT_LINE_NO", "REPORT_SECTION_NO", "REPORT_SECTION", "REPORT_LEVEL", F.lit(file_name).alias("FILE_NAME"),
        "ROW_TYPE_NO", "ROW_TYPE", "REPORT_LINE_LABEL", "REPORT_RESULT_LABEL", F.col("_REPORT_RESULT_VALUE").alias("REPORT_RESULT_VALUE"))


def long_report(filled: DataFrame) -> DataFrame:
    """Numbered report lines. One window over all: the report is as long as template times types."""
    order = Window.orderBy("ROW_TYPE_NO", "REPORT_SECTION_NO", "REPORT_LINE_NO")
    return filled.select(
        (F.row_number().over(order) - 1).cast("bigint").alias("REPORT_LINE_NO"), "FILE_NAME",
        "ROW_TYPE", "REPORT_LINE_LABEL", "REPORT_RESULT_LABEL", "REPORT_RESULT_VALUE")


def tabular_report(filled: DataFrame) -> DataFrame:
    """One row per record type, one column per result."""
    return (filled.groupBy("FILE_NAME", "ROW_TYPE_NO", "ROW_TYPE")
            .pivot("REPORT_RESULT_LABEL", list(RESULT_LABELS)).agg(F.sum("REPORT_RESULT_VALUE"))
            .select((F.col("ROW_TYPE_NO") + 1).alias("REPORT_LINE_NO"), "FILE_NAME", "ROW_TYPE",
                    *RESULT_LABELS)
            .orderBy("REPORT_LINE_NO"))
