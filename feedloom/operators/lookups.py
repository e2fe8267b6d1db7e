"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LINE, by_case, cut
from ..layouts.model import LOOKUP, Feed

KEY, VALUE = "_KEY", "_VALUE"

# A lookup is broadcast only up to this many rows of at most MAX_BROADCAST_CHARS characters each
# (about 100 MB); a larger one is left to the optimizer as an ordinary left join, where adaptive
# execution splits the partitions of hot codes.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_CHARS = 1_000
SPREAD = 4_096


def value_column(table: str) -> str:
    return f"_LOOKUP_{table}"


def checked_lookup(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Mark a lookup for broadcast if it is small; the check reads at most ``max_rows + 1`` rows."""
    head = lookup.select((F.length(KEY) + F.coalesce(F.length(VALUE), F.lit(0))).alias("n")) \
        .limit(max_rows + 1)
    rows, widest = head.agg(F.count(F.lit(1)), F.max("n")).first()
    small = rows <= max_rows and (widest or 0) <= MAX_BROADCAST_CHARS
    return (F.broadcast(lookup) if small else lookup), small


def lookup_key(feed: Feed, number: str, table: str) -> str:
    """Key of a lookup; it sits at other positions in other record types, null where unused."""
    branches = []
    for i, t in enumerate(feed.types):
        fields = [f for f in t.fields if f.rule == LOOKUP and f.table == table]
        if len(fields) > 1:
            raise ValueError(f"{t.name} uses lookup {table} more than once")
        branches += [(i, cut(f.start, f.start if f.first_char else f.end)) for f in fields]
    return by_case(number, branches, "NULL")


def attach_lookup(df: DataFrame, key: str, lookup: DataFrame, table: str) -> DataFrame:
    """Left join on a lookup with unique keys; adds the value, null for a miss.

    Lines of record types without this lookup have no key. Each gets one of ``SPREAD`` keys that no
    lookup holds, so that a join that shuffles does not bring all of them to one task.
    """
    none = f"concat('\\u0001', pmod(xxhash64({LINE}), {SPREAD}))" if LINE in df.columns else "NULL"
    key = f"coalesce({key}, {none})"
    renamed = lookup.select(F.col(KEY).alias(f"_KEY_{table}"),
                            F.col(VALUE).alias(value_column(table)))
    return df.join(renamed, F.expr(f"_KEY_{table} = {key}"), "left").drop(f"_KEY_{table}")
