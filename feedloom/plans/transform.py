"""From text lines to classified, checked and rendered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LINE, by_case, cut, name
from ..layouts.codes import LOOKUPS
from ..layouts.model import Feed
from ..operators.classify import (NO_TYPE, WRONG_LENGTH, discriminators, type_name,
                                  type_number)
from ..operators.lookups import attach_lookup, lookup_key
from ..operators.render import rendered
from ..operators.rules import (ACCEPTED, NO_EXCEPTIONS, Rule, failure_types, failures, field_rules, length_rule,
                               row_status, structure_rule)
from ..operators.translate import field_value
from ..sources.tables import constant_lookup

RESULT = ("_ROW_TYPE", "_ROW_STATUS", "_ROW_EXCEPTIONS", "_ROW_DATA")


def classified(lines: DataFrame, feed: Feed, filtered: bool = False) -> DataFrame:
    """Add the number of the record type.

    For rows that are then ``filtered`` by it, it is a generated column: the pushed-down filter would
    otherwise repeat the expression of the line for every discriminator of every record type.
    """
    parts = {column: F.expr(cut(*at)) for at, column in discriminators(feed).items()}
    number = type_number(feed)
    return lines.withColumns(parts) \
        .withColumn("_TYPE_NO", F.expr(f"explode(array({number}))" if filtered else number)).drop(*parts)


def with_lookups(df: DataFrame, feed: Feed, lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    """Join every lookup the feed uses; tables not given are the default ones.

    Given tables have unique keys and are joined as they come: ``checked_lookup`` marks a small one
    for broadcast, any other is left to the optimizer. The default tables have ten rows at most.
    """
    lookups = lookups or {}
    for table in feed.lookups():
        values = lookups.get(table)
        if values is None:
            values = F.broadcast(constant_lookup(df.sparkSession, LOOKUPS[table]))
        df = attach_lookup(df, lookup_key(feed, "_TYPE_NO", table), values, table)
    return df


def _carried(lines: DataFrame) -> list[str]:
    return [name(c) for c in lines.columns if c != LINE]


def _rules(feed: Feed) -> dict[int, list[Rule]]:
    """Rules per type number, in the order they are tested."""
    rules = {WRONG_LENGTH: [length_rule()],
             NO_TYPE: field_rules(feed, feed.common) + [structure_rule(feed)]}
    rules |= {i: field_rules(feed, t.fields) for i, t in enumerate(feed.types)}
    return {number: group for number, group in rules.items() if group}


def checked(lines: DataFrame, feed: Feed, lookups: dict[str, DataFrame] | None = None,
            filtered: bool = False) -> DataFrame:
    """Lines with their type number, lookup values and status.

    A generated column is not replaced by its expression when a filter on it is pushed down:
    routing by status does not evaluate the rules a second time.
    """
    status = by_case("_TYPE_NO", [(n, row_status(r)) for n, r in _rules(feed).items()], str(ACCEPTED))
    return with_lookups(classified(lines, feed, filtered), feed, lookups) \
        .withColumn("_ROW_STATUS", F.expr(f"explode(array({status}))"))


def _verdict(feed: Feed) -> list[str]:
    failed = by_case("_TYPE_NO", [(n, failures(r)) for n, r in _rules(feed).items()], NO_EXCEPTIONS)
    return [f"{type_name('_TYPE_NO', feed)} AS _ROW_TYPE",
            "_ROW_STATUS",
            f"CASE WHEN _ROW_STATUS = {ACCEPTED} THEN {NO_EXCEPTIONS} ELSE {failed} END AS _ROW_EXCEPTIONS"]


def transform(lines: DataFrame, feed: Feed, lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per line: type, status, failures, and the output text.

    ``_ROW_DATA`` is the delimited record of an accepted line and the untouched line of a rejected
    one. No Python worker, and no shuffle as long as the lookups are small: the rows stay in the
    order of ``lines``, next to all its columns but ``value``.
    """
    data = by_case("_TYPE_NO", [(i, rendered(t)) for i, t in enumerate(feed.types)], LINE)
    return checked(lines, feed, lookups).selectExpr(
        *_carried(lines), *_verdict(feed),
        f"CASE WHEN _ROW_STATUS = {ACCEPTED} THEN {data} ELSE {LINE} END AS _ROW_DATA")


def verdicts(lines: DataFrame, feed: Feed, lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    """The same without the output text of accepted lines: small enough to be kept for a whole run."""
    return checked(lines, feed, lookups).selectExpr(
        *_carried(lines), *_verdict(feed),
        f"CASE WHEN _ROW_STATUS <> {ACCEPTED} THEN {LINE} END AS _ROW_DATA")


def outcomes(lines: DataFrame, feed: Feed, lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    """Type, status and the types of the failures: all that the reconciliation counts."""
    none = "cast(array() AS array<string>)"
    failed = by_case("_TYPE_NO", [(n, failure_types(r)) for n, r in _rules(feed).items()], none)
    return checked(lines, feed, lookups).selectExpr(
        f"{type_name('_TYPE_NO', feed)} AS _ROW_TYPE", "_ROW_STATUS",
        f"CASE WHEN _ROW_STATUS = {ACCEPTED} THEN {none} ELSE {failed} END AS _FAILURES")


def extract(lines: DataFrame, feed: Feed, record_type: str,
            lookups: dict[str, DataFrame] | None = None, with_status: bool = False) -> DataFrame:
    """The lines of one record type with every field as a column, translated.

    Only this type's columns are planned: the table of all fields of all types would be far too wide.
    The rules are evaluated only ``with_status``.
    """
    t = feed.type(record_type)
    wanted = f"_TYPE_NO = {feed.types.index(t)}"
    if with_status:
        rows = checked(lines, feed, lookups, filtered=True).where(wanted)
    else:
        rows = with_lookups(classified(lines, feed, filtered=True).where(wanted), feed, lookups)
    return rows.selectExpr(*_carried(lines), *(["_ROW_STATUS"] if with_status else []),
                           *(f"{field_value(f, t)} AS {name(f.name)}" for f in t.fields))


def typed(lines: DataFrame, feed: Feed, lookups: dict[str, DataFrame] | None = None,
          record_types: tuple[str, ...] | None = None) -> DataFrame:
    """One nullable struct column per record type, null in rows of another type."""
    structs = []
    for i, t in enumerate(feed.types):
        if t.fields and (record_types is None or t.name in record_types):
            fields = ", ".join(f"{field_value(f, t)} AS {name(f.name)}" for f in t.fields)
            structs.append(f"CASE WHEN _TYPE_NO = {i} THEN struct({fields}) END AS {name(t.name)}")
    return with_lookups(classified(lines, feed), feed, lookups).selectExpr(
        *_carried(lines), f"{type_name('_TYPE_NO', feed)} AS _ROW_TYPE", *structs)
