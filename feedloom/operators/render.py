"""Re-assemble the fields of an accepted record as delimited text."""

from __future__ import annotations

from ..functions.text import LINE, blanks, cut, literal
from ..layouts.model import BLANK, PLAIN, Field, RecordType
from .translate import field_value

SEP = "|"


def runs(fields: tuple[Field, ...]) -> list[list[Field]]:
    """Group neighbouring fields that are copied unchanged from adjacent positions."""
    out: list[list[Field]] = []
    for f in fields:
        last = out[-1][-1] if out else None
        if f.rule == PLAIN and last is not None and last.rule == PLAIN and f.start == last.end + 1:
            out[-1].append(f)
        else:
            out.append([f])
    return out


def split_run(run: list[Field]) -> str:
    """Separators between adjacent fields, put in by one expression over the whole run.

    Cutting every field by itself walks the line from its start each time, which makes a record
    of 50 fields about twice as slow as this.
    """
    pattern = "(?s)" + "".join(f"(.{{{f.width}}})" for f in run)
    groups = SEP.join(f"${i + 1}" for i in range(len(run)))
    return (f"regexp_replace({cut(run[0].start, run[-1].end)}, {literal(pattern)}, "
            f"{literal(groups)})")


def rendered(t: RecordType) -> str:
    """``a|b|c`` in output order; a type without fields is passed through.

    Only for accepted lines: their fillers are known to be blank and are not read again.
    """
    if not t.fields:
        return LINE
    parts = []
    for run in runs(t.rendered):
        if len(run) > 1:
            parts.append(split_run(run))
        elif run[0].rule == BLANK:
            parts.append(blanks(run[0].width))
        else:
            parts.append(field_value(run[0], t))
    return parts[0] if len(parts) == 1 else f"concat_ws({literal(SEP)}, {', '.join(parts)})"
