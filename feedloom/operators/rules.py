"""Rules of a record type: the row status and the list of failures."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from ..functions.text import LINE, fill_in, holds, literal, not_all_blank
from ..layouts.model import BLANK, LOOKUP, MAPPED, Feed, Field
from .translate import raw_value, translated

# Row status codes (fixed values).
ACCEPTED, BAD_LENGTH, BAD_STRUCTURE, BAD_CODE, BAD_FILLER = 0, -1, -2, -3, -4

EXCEPTION_TYPE = "struct<type:string,source:string,desc:string>"
NO_EXCEPTIONS = f"cast(array() AS array<{EXCEPTION_TYPE}>)"


@dataclass(frozen=True)
class Rule:
    """All but ``status`` and ``kind`` are SQL expressions."""

    fails: str
    status: int
    kind: str
    source: str
    desc: str

    def failure(self) -> str:
        return (f"CASE WHEN {self.fails} THEN named_struct('type', {literal(self.kind)}, "
                f"'source', {self.source}, 'desc', {self.desc}) END")


def _quoted(before: str, value: str) -> str:
    return f"concat({literal(before + ' [')}, {value}, ']')"


def field_rule(feed: Feed, f: Field) -> Rule | None:
    source, value = literal(feed.exception_source(f)), raw_value(f)
    if f.rule == BLANK:
        return Rule(not_all_blank(f.start, f.end), BAD_FILLER, "INVALID_FILLER", source,
                    _quoted("Filler containing data", value))
    if f.rule == LOOKUP:
        return Rule(f"{translated(f)} IS NULL", BAD_CODE, "INVALID_XREF", source,
                    _quoted("No lookup value for", value))
    if f.rule == MAPPED:
        return Rule(f"{translated(f)} IS NULL", BAD_CODE, "INVALID_MAP", source,
                    _quoted("No mapped value for", value))
    return None


def field_rules(feed: Feed, fields: tuple[Field, ...]) -> list[Rule]:
    rules = (field_rule(feed, f) for f in fields)
    return [r for r in rules if r is not None]


def length_rule() -> Rule:
    return Rule("true", BAD_LENGTH, "INVALID_LENGHT", "'ROW'",
                _quoted("Invalid row length", f"cast(length({LINE}) AS string)"))


def structure_rule(feed: Feed) -> Rule:
    whens = " ".join(f"WHEN {holds(s.when)} THEN {fill_in(s.source)}" for s in feed.structure)
    return Rule("true", BAD_STRUCTURE, "INVALID_STRUCTURE", f"CASE {whens} END",
                "'Invalid row type'")


def row_status(rules: list[Rule]) -> str:
    """Status of the last failing rule, 0 if none fails."""
    whens = []
    for status, group in groupby(reversed(rules), key=lambda r: r.status):
        whens.append(f"WHEN {' OR '.join(r.fails for r in group)} THEN {status}")
    return f"CASE {' '.join(whens)} ELSE {ACCEPTED} END" if whens else str(ACCEPTED)


def failures(rules: list[Rule]) -> str:
    """Failures in rule order."""
    if not rules:
        return NO_EXCEPTIONS
    return f"filter(array({', '.join(r.failure() for r in rules)}), x -> x IS NOT NULL)"


def failure_types(rules: list[Rule]) -> str:
    """Only the types of the failures, in rule order: no text is built."""
    whens = ", ".join(f"CASE WHEN {r.fails} THEN {literal(r.kind)} END" for r in rules)
    return f"filter(array({whens}), x -> x IS NOT NULL)" if rules else "cast(array() AS array<string>)"
