"""Value of a field: cut out of the line, then translated by its rule."""

from __future__ import annotations

from ..functions.text import cut, literal, translate
from ..layouts.codes import CODE_MAPS, DEFAULTS
from ..layouts.model import JOINED, LOOKUP, MAPPED, RECODE, Field, RecordType
from .lookups import value_column


def raw_value(f: Field) -> str:
    return cut(f.start, f.end)


def translated(f: Field) -> str:
    """Translation of a lookup or mapped field, null on a miss."""
    if f.rule == LOOKUP:
        return value_column(f.table)
    key = raw_value(f)
    return translate(CODE_MAPS[f.table], f"trim({key})" if f.trim_key else key)


def field_value(f: Field, of: RecordType) -> str:
    """What the field holds in the output; an unknown code keeps its original value."""
    if f.rule in (LOOKUP, MAPPED):
        return f"coalesce({translated(f)}, {raw_value(f)})"
    if f.rule == RECODE:
        default = DEFAULTS[f.table]
        other = raw_value(f) if default is None else literal(default)
        return f"coalesce({translated(f)}, {other})"
    if f.rule == JOINED:
        return _joined(f, of)
    return raw_value(f)


def _joined(f: Field, of: RecordType) -> str:
    parts = []
    for p in f.parts:
        if isinstance(p, tuple):
            parts.append(cut(*p))
        elif p.startswith("="):
            parts.append(literal(p[1:]))
        else:
            parts.append(translated(of.field(p)))
    # concat is null, hence the field empty, when a part has no translation
    return f"coalesce(concat({', '.join(parts)}), '')"
