"""SQL expressions for fixed-width text.

Expressions are built as SQL text and parsed once by Spark: a feed has hundreds of fields, and one
``Column`` call per field would take longer to plan than a small file takes to run.
"""

from __future__ import annotations

import re

from ..layouts.model import Test

LINE = "value"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def cut(start: int, end: int, line: str = LINE) -> str:
    """Characters ``start..end`` of the line, 1-based and inclusive; short past the end."""
    return f"substring({line}, {start}, {end - start + 1})"


def blanks(width: int) -> str:
    """A blank text; constant folding turns a repetition into one literal."""
    return f"repeat(' ', {width})" if width > 8 else literal(" " * width)


def holds(tests: tuple[Test, ...], at: dict[tuple[int, int], str] | None = None) -> str:
    """All tests hold; no test at all is always true. ``at`` names parts that are already cut."""
    def one(t: Test) -> str:
        text = blanks(len(t.text)) if not t.text.strip() else literal(t.text)
        part = (at or {}).get((t.start, t.end)) or cut(t.start, t.end)
        return f"{part} {'=' if t.equal else '<>'} {text}"
    return " AND ".join(one(t) for t in tests) or "true"


def not_all_blank(start: int, end: int) -> str:
    return f"{cut(start, end)} <> {blanks(end - start + 1)}"


def fill_in(text: str) -> str:
    """Replace ``{a}`` and ``{a-b}`` in a literal by characters of the line."""
    parts = []
    for piece in re.split(r"(\{\d+(?:-\d+)?\})", text):
        place = re.fullmatch(r"\{(\d+)(?:-(\d+))?\}", piece)
        if place:
            parts.append(cut(int(place[1]), int(place[2] or place[1])))
        elif piece:
            parts.append(literal(piece))
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"


def translate(codes: dict[str, str], key: str) -> str:
    """Value of a constant code map, null for an unknown code."""
    entries = ", ".join(literal(x) for pair in codes.items() for x in pair)
    return f"map({entries})[{key}]"


def by_case(selector: str, branches: list[tuple[int, str]], otherwise: str) -> str:
    if not branches:
        return otherwise
    whens = " ".join(f"WHEN {number} THEN {value}" for number, value in branches)
    return f"CASE {selector} {whens} ELSE {otherwise} END"
