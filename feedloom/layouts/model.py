"""Declarative description of a fixed-width feed.

Positions are 1-based and inclusive, counted in characters, like ``substring``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

UNRECOGNIZED = "<Unrecognized>"

# What a field does besides being cut out of the line.
PLAIN = "plain"        # value as is
BLANK = "blank"        # filler, must hold only blanks
LOOKUP = "lookup"      # translated by a lookup table, a miss rejects the row
MAPPED = "mapped"      # translated by a constant code map, a miss rejects the row
RECODE = "recode"      # translated by a constant code map with a default, never rejects
JOINED = "joined"      # built from other parts of the row


@dataclass(frozen=True)
class Field:
    name: str
    start: int = 0
    end: int = 0
    rule: str = PLAIN
    table: str = ""            # lookup or code map
    source: str = ""           # name reported in an exception, default derived from the rule
    trim_key: bool = False     # trim the code before the map is asked
    first_char: bool = False   # only the first character is the lookup key
    parts: tuple = ()          # JOINED: (start, end), a field name, or a literal as "=text"
    hidden: bool = False       # checked and extractable, but not rendered

    @property
    def width(self) -> int:
        return self.end - self.start + 1


@dataclass(frozen=True)
class Test:
    """``line[start..end]`` equals (or differs from) a text."""

    start: int
    end: int
    text: str
    equal: bool = True


@dataclass(frozen=True)
class RecordType:
    name: str
    when: tuple[Test, ...]
    fields: tuple[Field, ...] = ()     # no fields: the line is passed through verbatim

    @property
    def rendered(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if not f.hidden)

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(f"{self.name} has no field {name}")


@dataclass(frozen=True)
class Structure:
    """How an unrecognized line is reported; the first entry whose tests hold is used.

    ``{a}`` and ``{a-b}`` in the source stand for characters of the line.
    """

    source: str
    when: tuple[Test, ...] = ()


@dataclass(frozen=True)
class Feed:
    name: str
    row_length: int
    types: tuple[RecordType, ...]
    structure: tuple[Structure, ...]
    common: tuple[Field, ...] = ()     # checked on every line of the right length
    filler_from: int = 1               # position of the first character in filler labels
    map_suffix: str = ""               # appended to the field name in map exceptions
    _index: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        names = [t.name for t in self.types]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: duplicate record type")
        self._index.update({n: i for i, n in enumerate(names)})

    def type(self, name: str) -> RecordType:
        return self.types[self._index[name]]

    def lookups(self) -> tuple[str, ...]:
        """Names of the lookup tables the feed needs, in first-use order."""
        return tuple(dict.fromkeys(
            f.table for t in self.types for f in t.fields if f.rule == LOOKUP))

    def exception_source(self, f: Field) -> str:
        if f.source:
            return f.source
        if f.rule == BLANK:
            first = f.start - 1 + self.filler_from
            span = f"{first}" if first == f.end else f"{first}:{f.end}"
            return f"FILLER@[{span}] ({f.name.split()[-1]})"
        return f.name + (self.map_suffix if f.rule == MAPPED else "")


_ITEM = re.compile(r"(.*\S)\s+(\d+)(?:-(\d+))?$", re.S)


def plain(items: str, hidden: bool = False) -> tuple[Field, ...]:
    """Fields without a rule, as ``NAME a-b; NAME a; ...``."""
    out = []
    for item in items.split(";"):
        name, a, b = _ITEM.match(item.strip()).groups()
        out.append(Field(name, int(a), int(b or a), hidden=hidden))
    return tuple(out)


def blank(name: str, start: int, end: int, source: str = "", hidden: bool = False) -> Field:
    return Field(name, start, end, BLANK, source=source, hidden=hidden)


def lookup(name: str, start: int, end: int, table: str, source: str = "",
           first_char: bool = False) -> Field:
    return Field(name, start, end, LOOKUP, table, source, first_char=first_char)


def mapped(name: str, start: int, end: int, table: str, source: str = "",
           trim_key: bool = False, hidden: bool = False) -> Field:
    return Field(name, start, end, MAPPED, table, source, trim_key=trim_key, hidden=hidden)


def recode(name: str, at: int, table: str) -> Field:
    return Field(name, at, at, RECODE, table)


def joined(name: str, *parts, hidden: bool = False) -> Field:
    return Field(name, rule=JOINED, parts=parts, hidden=hidden)


def date_parts(stem: str, start: int) -> tuple[Field, ...]:
    """Century, year, month and day, two characters each."""
    return tuple(Field(stem + part, start + 2 * i, start + 2 * i + 1)
                 for i, part in enumerate(("CC", "YY", "MM", "DD")))


def record(name: str, when, *fields) -> RecordType:
    flat = []
    for f in fields:
        flat.extend([f] if isinstance(f, Field) else f)
    names = [f.name for f in flat]
    if len(set(names)) != len(names):
        raise ValueError(f"{name}: duplicate field")
    return RecordType(name, (when,) if isinstance(when, Test) else tuple(when), tuple(flat))


def is_(start: int, end: int, text: str) -> Test:
    return Test(start, end, text)


def is_blank(start: int, end: int) -> Test:
    return Test(start, end, " " * (end - start + 1))


def not_blank(start: int, end: int) -> Test:
    return Test(start, end, " " * (end - start + 1), equal=False)
