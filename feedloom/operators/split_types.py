"""Split the memo position feed into one trimmed table per record type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LINE, literal
from ..layouts.memo_position import SPLIT_RANGES

# White space that is trimmed from a cell (fixed value).
SPACES = ("\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
          "\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff")

HEADER_MARK = "DATE="


def split_cells(lines: DataFrame) -> DataFrame:
    """``_SHEET`` and the trimmed ``_CELLS`` of every line that belongs to a sheet."""
    code = f"substring({LINE}, 25, 1)"
    known = ", ".join(literal(s) for s in SPLIT_RANGES if s != "header")
    sheet = (f"CASE WHEN contains({LINE}, {literal(HEADER_MARK)}) THEN 'header' "
             f"WHEN {code} IN ({known}) THEN {code} END")
    whens = " ".join(
        f"WHEN {literal(s)} THEN array("
        + ", ".join(f"btrim(substring({LINE}, {a + 1}, {b - a}), {literal(SPACES)})" for a, b in ranges)
        + ")" for s, ranges in SPLIT_RANGES.items())
    return (lines.withColumn("_SHEET", F.expr(sheet)).where("_SHEET IS NOT NULL")
            .selectExpr("_ROW_ID", "_SHEET", f"CASE _SHEET {whens} END AS _CELLS"))


def sheet_table(lines: DataFrame, sheet: str) -> DataFrame:
    """One sheet as a table with columns ``c1``, ``c2``, ..."""
    cells = split_cells(lines).where(F.col("_SHEET") == sheet)
    return cells.select("_ROW_ID", *(F.col("_CELLS")[i].alias(f"c{i + 1}")
                                     for i in range(len(SPLIT_RANGES[sheet]))))
