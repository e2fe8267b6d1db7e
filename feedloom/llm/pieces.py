"""Cuts a text where no byte-level BPE token can cross, so that equal pieces are encoded once.

The pre-tokenizer lets white space and the following word meet only in one space before the word.
Before a space that follows a non-space character a token therefore always ends: the text may be cut
there, and pieces can be encoded one by one with the same ids as the whole text.
"""

from __future__ import annotations

import re

_INSIDE_RUN = re.compile(r"[\s\x1c-\x1f] ")
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f])(?= )")


def cut(text: str) -> tuple[str, list[str]]:
    """The first piece of a text, and the others in order without the space that each begins with."""
    if _INSIDE_RUN.search(text):
        first, *rest = _CUT.split(text)
        return first, [piece[1:] for piece in rest]
    first, *rest = text.split(" ")
    return first, rest


class Pieces(dict):
    """Results by piece; a miss calls ``encode(piece)``. Emptied when full, which changes no result."""

    def __init__(self, encode, most: int = 350_000):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, piece):
        if len(self) >= self.most:
            self.clear()
        value = self[piece] = self.encode(piece)
        return value


class PieceEncoder:
    """``each(text)``: the results of a text's pieces, in order."""

    def __init__(self, encode):
        self.plain = Pieces(encode)
        self.spaced = Pieces(lambda piece: encode(" " + piece))

    def each(self, text: str) -> list:
        if _INSIDE_RUN.search(text):
            return [self.plain[piece] for piece in _CUT.split(text)]
        first, *rest = text.split(" ")
        spaced = self.spaced
        return [self.plain[first], *[spaced[piece] for piece in rest]]
