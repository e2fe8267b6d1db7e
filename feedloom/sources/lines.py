"""Text-line sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORIGIN = ("_FILE", "_BLOCK")
UTF8 = ("UTF-8", "UTF8")
# Charsets that Spark's ``decode`` reads, and that map every byte (or fail on none): no line is lost.
SINGLE_BYTE = ("ISO-8859-1", "LATIN1")


def decoded(value, encoding: str | None):
    """A text line as characters of ``encoding``; null where its bytes are no text of that encoding.

    A text scan keeps the bytes of a line as they stand in the file, so the line as ``binary`` is exactly
    those bytes: UTF-8 lines are checked with ``is_valid_utf8`` (a bad lead or continuation byte would
    otherwise swallow its neighbours and change every width and position behind it), single-byte charsets
    are decoded byte for byte. ``None`` keeps the scan's string as it is.
    """
    if encoding is None:
        return value
    name = encoding.upper().replace("_", "-")
    if name in UTF8:
        return F.when(F.is_valid_utf8(value), value)
    if name in ("US-ASCII", "ASCII"):
        return F.when(F.is_valid_utf8(value) & ~value.rlike("[^\\x00-\\x7F]"), value)
    if name in SINGLE_BYTE:
        return F.decode(value.cast("binary"), "ISO-8859-1")
    raise ValueError(f"unsupported encoding {encoding!r}; one of {UTF8 + SINGLE_BYTE + ('US-ASCII',)}")


def read_lines(spark: SparkSession, path: str | list[str], origin: bool = False,
               encoding: str | None = None) -> DataFrame:
    """``_ROW_ID`` and ``value`` of every text line.

    The row id grows with the position of the line in its file; several files may be interleaved.
    With ``origin`` the file and the start of its block come along, so that
    ``(_FILE, _BLOCK, _ROW_ID)`` is the order of the files one after the other. With an ``encoding``
    (see ``decoded``) a line that is no text of it has a null ``value``, and ``_BYTES`` holds its bytes
    as hex (null for every line that decodes), so a run quarantines it with the bytes it had.
    """
    lines = spark.read.text(path)
    value = decoded(F.col("value"), encoding)
    columns = [F.monotonically_increasing_id().alias("_ROW_ID"), value.alias("value")]
    if encoding is not None:
        columns.append(F.when(value.isNull(), F.hex(F.col("value").cast("binary"))).alias("_BYTES"))
    if origin:
        columns += [F.col("_metadata.file_path").alias("_FILE"),
                    F.col("_metadata.file_block_start").alias("_BLOCK")]
    return lines.select(*columns)


def table_lines(spark: SparkSession, name: str, column: str = "value") -> DataFrame:
    """The same from a catalog table with one text column."""
    return spark.table(name).select(F.monotonically_increasing_id().alias("_ROW_ID"),
                                    F.col(column).cast("string").alias("value"))


def readable(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").isNotNull())


def unreadable(lines: DataFrame) -> DataFrame:
    """Rows without a line; they are quarantined, not classified."""
    return lines.where(F.col("value").isNull())
