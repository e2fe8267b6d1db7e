"""Output datasets. Every output is a folder; only reports are merged into one file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.exceptions import EXCEPTION_COLUMNS
from ..sources.lines import ORIGIN

CRLF = "\r\n"
REJECTED_COLUMNS = ("_ROW_ID", "_ROW_TYPE", "_ROW_STATUS", "_ROW_DATA")


def write_target(accepted: DataFrame, path: str, mode: str = "append",
                 order: tuple[str, ...] | None = None) -> None:
    """Accepted records as text lines.

    Rows that come straight from a scan are already in source order, file by file of the output,
    so nothing is shuffled. Give ``order`` (``_ROW_ID``, or origin columns and ``_ROW_ID``) for rows
    that lost it: they are range-partitioned, never merged into one task.
    """
    rows = accepted.orderBy(*order) if order else accepted
    rows.select("_ROW_DATA").write.mode(mode).option("lineSep", CRLF).text(path)


def write_target_by_file(accepted: DataFrame, path: str, files: list[str], mode: str = "append",
                         moved: bool = False) -> None:
    """Accepted records of text files, one folder ``file=<name>`` per source file, in source order.

    The tasks that read a file ascend with it, so nothing is shuffled: each task sorts what it has by
    file, block and row id. Only rows that were ``moved`` by a join are range-partitioned first. Files
    of one name in several folders are told apart by their whole path.
    """
    base = {f.rsplit("/", 1)[-1] for f in files}
    name = F.regexp_extract("_FILE", "([^/]+)$", 1) if len(base) == len(files) else F.regexp_replace("_FILE", "[/:]+", "_")
    rows = accepted.select("_ROW_DATA", name.alias("file"), *ORIGIN, "_ROW_ID")
    order = ("file", *ORIGIN, "_ROW_ID")
    rows = (rows.repartitionByRange(*order) if moved else rows).sortWithinPartitions(*order)
    rows.select("_ROW_DATA", "file").write.mode(mode).option("lineSep", CRLF).partitionBy("file").text(path)


def write_pipe_csv(df: DataFrame, path: str, mode: str = "append", keep_blanks: bool = True) -> None:
    """A fixed-width line without its blanks could not be processed again, so blanks are kept."""
    writer = df.write.mode(mode).option("header", True).option("sep", "|").option("lineSep", CRLF)
    if keep_blanks:
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def write_rejected(rejected: DataFrame, path: str, mode: str = "append",
                   order: tuple[str, ...] = ("_ROW_ID",)) -> None:
    """Rejected lines ordered by type, then by ``order``, which spreads a type over partitions."""
    write_pipe_csv(rejected.orderBy("_ROW_TYPE", *order).select(*REJECTED_COLUMNS), path, mode)


def write_exceptions(exceptions: DataFrame, path: str, mode: str = "append",
                     order: tuple[str, ...] | None = None) -> None:
    rows = exceptions.orderBy(*order) if order else exceptions
    write_pipe_csv(rows.select(*EXCEPTION_COLUMNS), path, mode)


def write_diagnostic(accepted: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Accepted records with row id and type, blanks kept, sorted within each output file."""
    rows = accepted.select("_ROW_ID", "_ROW_TYPE", "_ROW_DATA").sortWithinPartitions("_ROW_ID")
    write_pipe_csv(rows, path, mode)


def write_report(report: DataFrame, path: str, mode: str = "append") -> None:
    """A report, tab-delimited and unquoted, as one file: it is as small as its template."""
    report.repartition(1).sortWithinPartitions("REPORT_LINE_NO").write.mode(mode) \
        .option("header", True).option("sep", "\t").option("lineSep", CRLF).option("quote", "") \
        .csv(path)


def write_quarantine(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Rows that cannot be read as a line."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_if_any(rows: DataFrame, write, *args, **options) -> bool:
    """Skip the output when there is nothing to write; looks at the first row only."""
    if rows.isEmpty():
        return False
    write(rows, *args, **options)
    return True


def write_manifest(manifest: DataFrame, path: str, mode: str = "overwrite") -> None:
    manifest.write.mode(mode).option("header", True).csv(path)


def write_split(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per sheet, written in one pass."""
    cells.select("_SHEET", F.concat_ws("|", "_CELLS").alias("value")) \
        .write.mode(mode).partitionBy("_SHEET").text(path)
