"""Lines of any feed, derived row by row from a table.

One line per row: the layout says where record type, codes and blanks belong, digits of the row
fill the rest, and fixed shares of the rows get a wrong length, an unknown type, a dirty filler
or an unknown code. The text is built by one SQL expression that Spark and other engines read alike.
"""

from __future__ import annotations

from ..layouts.codes import CODE_MAPS, LOOKUPS
from ..layouts.model import BLANK, LOOKUP, MAPPED, RECODE, Feed, RecordType

BROKEN_LENGTH, UNKNOWN_TYPE, DIRTY_FILLER = 17, 19, 13

# key and digits of one source row, per table
KEYS = {
    "lineitem": "(l_orderkey * 10 + l_linenumber)",
    "orders": "o_orderkey",
    "customer": "c_custkey",
}
DIGITS = {
    "lineitem": ("lpad(CAST(l_orderkey AS STRING), 9, '0') || lpad(CAST(l_partkey AS STRING), 7, '0')"
                 " || lpad(CAST(l_suppkey AS STRING), 6, '0') || CAST(l_linenumber AS STRING)"
                 " || lpad(CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING), 12, '0')"
                 " || l_returnflag || l_linestatus"),
    "orders": ("lpad(CAST(o_orderkey AS STRING), 9, '0') || lpad(CAST(o_custkey AS STRING), 8, '0')"
               " || o_orderstatus"
               " || lpad(CAST(CAST(floor(o_totalprice * 100) AS BIGINT) AS STRING), 13, '0')"),
    "customer": "lpad(CAST(c_custkey AS STRING), 9, '0') || rpad(c_name, 20, ' ')",
}


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _code_sql(keys: list[str], width: int, stride: int) -> str:
    """Pick a code by the row key; one choice in 3 n + 1 is unknown."""
    choices = [k.ljust(width) for k in keys] * 3 + ["?" * width]
    at = f"CAST(floor(k / {stride}) AS BIGINT) % {len(choices)}"
    return f"substr({_quote(''.join(choices))}, CAST(({at}) * {width} + 1 AS INT), {width})"


def _segments(feed: Feed, t: RecordType) -> dict[int, tuple[int, str]]:
    """Start position -> (end, SQL) of everything that is not free text."""
    out: dict[int, tuple[int, str]] = {}
    taken = [False] * (feed.row_length + 2)

    def put(start: int, end: int, sql: str) -> None:
        if not any(taken[start:end + 1]):
            out[start] = (end, sql)
            taken[start:end + 1] = [True] * (end - start + 1)

    for x in t.when:
        if x.equal:
            put(x.start, x.end, _quote(x.text))
        else:
            put(x.start, x.start, "'A'")
    blanks = [f for f in t.fields if f.rule == BLANK and not f.hidden]
    for turn, f in enumerate(blanks):
        # the last character of a filler is dirty in some rows, of every filler in its turn
        put(f.end, f.end, f"CASE WHEN k % {DIRTY_FILLER} = 0 AND CAST(floor(k / {DIRTY_FILLER * len(feed.types)}) AS BIGINT)"
                          f" % {len(blanks)} = {turn} THEN 'x' ELSE ' ' END")
        for p in range(f.start, f.end + 1):
            put(p, p, "' '")
    stride = 1
    for f in t.fields:
        if f.rule in (LOOKUP, MAPPED, RECODE):
            stride += 2
            keys = list((LOOKUPS if f.rule == LOOKUP else CODE_MAPS)[f.table])
            if f.first_char:
                put(f.start, f.start, _code_sql(keys, 1, stride))
            else:
                put(f.start, f.end, _code_sql(keys, f.width, stride))
    return out


def _line_sql(feed: Feed, t: RecordType) -> str:
    parts, blank_run, at = [], 0, 1

    def flush():
        nonlocal blank_run
        if blank_run:
            parts.append(_quote(" " * blank_run))
            blank_run = 0

    segments = _segments(feed, t)
    while at <= feed.row_length:
        if at in segments:
            end, sql = segments[at]
            if sql.strip("'") == " " * (end - at + 1):
                blank_run += end - at + 1
            else:
                flush()
                parts.append(sql)
        else:
            flush()
            following = [s for s in segments if s > at]
            end = min(following, default=feed.row_length + 1) - 1
            parts.append(f"substr(b, {at}, {end - at + 1})")
        at = end + 1
    flush()
    return " || ".join(parts)


def unknown_line_sql(feed: Feed) -> str:
    """A line of the right length that no record type claims, if the feed can have one."""
    return f"rpad('?????????????????????', {feed.row_length}, 'Q')"


def lines_sql(feed: Feed, table: str = "lineitem") -> str:
    """SELECT giving ``_ROW_ID`` and ``value`` for every row of the table."""
    n = len(feed.types)
    whens = " ".join(f"WHEN k % {n} = {i} THEN {_line_sql(feed, t)}"
                     for i, t in enumerate(feed.types))
    copies = feed.row_length // 20 + 1
    return (
        f"SELECT k AS _ROW_ID, CASE WHEN k % {BROKEN_LENGTH} = 0"
        f" THEN substr(v, 1, {feed.row_length - 1}) ELSE v END AS value FROM ("
        f"SELECT k, CASE WHEN k % {UNKNOWN_TYPE} = 0 THEN {unknown_line_sql(feed)} {whens} END AS v FROM ("
        f"SELECT {KEYS[table]} AS k, substr(repeat({DIGITS[table]}, {copies}), 1, {feed.row_length}) AS b"
        f" FROM {table}) s0) s1")
