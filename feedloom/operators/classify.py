"""Choose the record type of a line."""

from __future__ import annotations

from ..functions.text import LINE, by_case, holds, literal
from ..layouts.model import UNRECOGNIZED, Feed

WRONG_LENGTH = -1
NO_TYPE = -2


def discriminators(feed: Feed) -> dict[tuple[int, int], str]:
    """The parts of a line that tell its type, as columns: each is cut once, not once per type."""
    return {(x.start, x.end): f"_AT_{x.start}_{x.end}" for t in feed.types for x in t.when}


def type_number(feed: Feed) -> str:
    """Index of the first record type whose tests hold, or a negative number.

    An integer keeps the later ``CASE`` expressions cheap; ``type_name`` turns it into the name.
    Reads the columns of ``discriminators``.
    """
    at = discriminators(feed)
    whens = " ".join(f"WHEN {holds(t.when, at)} THEN {i}" for i, t in enumerate(feed.types))
    return f"CASE WHEN length({LINE}) <> {feed.row_length} THEN {WRONG_LENGTH} {whens} ELSE {NO_TYPE} END"


def type_name(number: str, feed: Feed) -> str:
    return by_case(number, [(i, literal(t.name)) for i, t in enumerate(feed.types)],
                   literal(UNRECOGNIZED))
