"""License scans: an exact set-similarity join of text blocks with license notices.

A block is a line, or a paragraph: a run of lines that no line without words parts, so that notices wrapped
over lines are found (comment marks are no words). Its set, like a template's, is that of its words. Tokens are ordered by their count
in the whole corpus, rare first. A block that holds ``CONTAINMENT`` of a template's tokens must hold one
of the template's first ``|T| - ceil(c |T|) + 1`` tokens, so only those are indexed; candidates must be
long enough, and the place of the first common token must leave enough tokens; the rest is verified.
Templates are a fixed list, so their index is small and broadcast. License phrases, whose words stand
one after the other anywhere in the text, are found beside it.

Lower-casing is A-Z only. Null and empty texts have no words, places or labels. Blocks of any length
are taken whole, equal blocks each count, repeated rows are all returned, extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready

CONTAINMENT = 0.8
# License phrases with their labels, and usual license notices.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NOTICES = {
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-program-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                          "the GNU General Public License as published by the Free Software Foundation",
    "mit-notice": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                      "provided that the following conditions are met",
}
# Bytes that are part of a word: digits, letters (lower-cased), all of other scripts; the others part words.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))
_LINES = bytes(0x0A if b == 0x0A else _TABLE[b] for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def phrase_places(found: list[bytes], phrases: dict[tuple[bytes, ...], str]) -> tuple[list[int], set[str]]:
    """Starts of all phrases (a start counts once per phrase) and their labels."""
    starts, labels = [], set()
    for phrase, label in phrases.items():
        at = -1
        while True:
            try:
                at = found.index(phrase[0], at + 1)
            except ValueError:
                break
            if tuple(found[at:at + len(phrase)]) == phrase:
                starts.append(at)
                labels.add(label)
    return starts, labels


class NoticeIndex:
    """Prefix index of the templates under a token order."""

    def __init__(self, notices: dict[str, str], counts: dict[bytes, int], containment: float):
        self.rank = {t: k for k, t in enumerate(sorted(
            {t for text in notices.values() for t in words(text)}, key=lambda t: (counts.get(t, 0), t)))}
        self.templates, self.index = [], {}
        for label, text in notices.items():
            ordered = sorted(set(words(text)), key=self.rank.__getitem__)
            need = -(-int(round(containment * 1000)) * len(ordered) // 1000)
            for place, token in enumerate(ordered[:len(ordered) - need + 1]):
                self.index.setdefault(token, []).append((len(self.templates), place))
            self.templates.append((label, frozenset(ordered), len(ordered), need))

    def matches(self, block: list[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of the templates that the block contains."""
        tokens = set(block)
        known = sorted((t for t in tokens if t in self.rank), key=self.rank.__getitem__)
        out, tried = [], set()
        for at, token in enumerate(known):
            for number, place in self.index.get(token, ()):
                label, template, size, need = self.templates[number]
                if number in tried:
                    continue
                tried.add(number)  # this is the first common token
                if len(tokens) < need or 1 + min(size - place - 1, len(known) - at - 1) < need:
                    continue
                both = len(template & tokens)
                if both >= need:
                    out.append((label, both / size))
        return out


def paragraphs(lines: list[list[bytes]]):
    """(first line, last line) of all runs of two or more lines with words."""
    first = None
    for number, line in enumerate([*lines, []]):
        if line and first is None:
            first = number
        elif not line and first is not None:
            if number - first > 1:
                yield first, number - 1
            first = None


def notice_token_counts(docs: DataFrame, notices: dict[str, str], text_column: str = "text") -> dict[bytes, int]:
    """How often each token of the notices occurs in the whole corpus."""
    vocabulary = frozenset(t for text in notices.values() for t in words(text))

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(t for t in words(text.as_py()) if t in vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                                         names=["token", "n"])

    python_ready(docs.sparkSession)
    rows = docs.select(F.col(text_column).alias("text")).filter("text is not null") \
        .mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {bytes(row.token): row.n for row in rows}


MATCH = "array<struct<block: bigint, label: string, containment: double>>"
WRAPPED = "array<struct<first: bigint, last: bigint, label: string, containment: double>>"


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, containment: float = CONTAINMENT,
                  phrases: dict[str, str] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, starts, phrase_labels, matches, wrapped) per document; matches: line number, notice,
    containment; wrapped: the same of paragraphs of several lines, with their first and last line."""
    notices = NOTICES if notices is None else notices
    shared = docs.sparkSession.sparkContext.broadcast(
        (NoticeIndex(notices, notice_token_counts(docs, notices, text_column), containment),
         {tuple(words(phrase)): label for phrase, label in (PHRASES if phrases is None else phrases).items()}))

    def run(batches):
        index, wanted = shared.value
        prefix, anchors = frozenset(index.index), frozenset(phrase[0] for phrase in wanted)
        for batch in batches:
            counts, starts, labels, matches, wrapped = [], [], [], [], []
            for value in batch.column(1):
                raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                found = raw.translate(_TABLE).split()
                counts.append(len(found))
                places, named = phrase_places(found, wanted) if not anchors.isdisjoint(found) else ([], set())
                starts.append(sorted(places))
                labels.append(sorted(named))
                rows, runs = [], []
                if not prefix.isdisjoint(found):
                    lines = [line.split() for line in raw.translate(_LINES).split(b"\n")]
                    for number, tokens in enumerate(lines):
                        if not prefix.isdisjoint(tokens):
                            rows += [{"block": number, "label": label, "containment": share}
                                     for label, share in index.matches(tokens)]
                    for first, last in paragraphs(lines):
                        tokens = [t for line in lines[first:last + 1] for t in line]
                        if not prefix.isdisjoint(tokens):
                            runs += [{"first": first, "last": last, "label": label, "containment": share}
                                     for label, share in index.matches(tokens)]
                matches.append(rows)
                wrapped.append(runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(starts, pa.list_(pa.int64())),
                 pa.array(labels, pa.list_(pa.string())), pa.array(matches, pa.list_(pa.struct(
                     [("block", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))),
                 pa.array(wrapped, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()),
                                                       ("containment", pa.float64())])))],
                names=[id_column, "n_words", "starts", "phrase_labels", "matches", "wrapped"])

    rows = docs.select(id_column, text_column)
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_words long, starts array<bigint>, "
                                f"phrase_labels array<string>, matches {MATCH}, wrapped {WRAPPED}")
