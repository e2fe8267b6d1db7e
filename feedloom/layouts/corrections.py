"""Where the published layouts lay one field over another, and what the layouts here make of it.

Fixed values: record type, field, published characters. Next to them the mended characters: a sign keeps
its character, and a filler that must be blank leaves the data beside it alone (otherwise every record
with that data would be rejected).
"""

from __future__ import annotations

from dataclasses import replace

from .model import Feed

CORRECTIONS = {
    "position_balance": (
        ("Customer Position Header", "HOUSE REQUIREMENT AMOUNT", (258, 276), (260, 276)),
        ("Customer Balance, Last in Account", "MARGIN/CASH DEFICIENCY", (203, 221), (205, 221)),
        ("Option Header", "FILLER 8", (259, 297), (259, 296)),
        ("When-Issue Customer Header", "FILLER 2", (61, 68), (67, 68)),
        ("When-Issue Trading Header", "FILLER 2", (61, 68), (67, 68)),
        ("Trading Analysis Trade Date", "FILLER 9", (234, 348), (235, 348)),
        ("Customer Balance, Last in Account", "FILLER 8", (297, 303), (298, 303)),
    ),
    "registered_plan": (
        ("PRINCIPAL RECORD 2", "FILLER 9", (132, 133), (133, 133)),
    ),
}


def mended(feed: Feed) -> Feed:
    """The feed with its corrections; a published field that is not where it should be is an error."""
    changes = {(record, field): (published, put) for record, field, published, put in CORRECTIONS.get(feed.name, ())}
    types = []
    for t in feed.types:
        fields = []
        for f in t.fields:
            published, put = changes.pop((t.name, f.name), (None, None))
            if published and (f.start, f.end) != published:
                raise ValueError(f"{t.name}, {f.name}: expected at {published}")
            fields.append(replace(f, start=put[0], end=put[1]) if put else f)
        types.append(replace(t, fields=tuple(fields)))
    if changes:
        raise ValueError(f"no such fields: {sorted(changes)}")
    return replace(feed, types=tuple(types), _index={})


def with_row_length(feed: Feed, row_length: int) -> Feed:
    """The feed for lines of another length; fields beyond its end read as empty."""
    return replace(feed, row_length=row_length, _index={})
