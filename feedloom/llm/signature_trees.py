"""Linked pairs of sets by dual traversal of signature trees (numpy, inside one task).

A leaf holds up to ``LEAF`` sets, a node up to ``FAN`` nodes below it; both know the OR of the token
bitmaps below, the range of set sizes, and how many tokens of a set its bitmap may hide. Two nodes are
visited together only if some pair below could overlap enough: the size ranges must be compatible, and
the common bits plus the hidden tokens must reach the overlap that the similarity asks for. Pairs of
nodes whose sets are all linked already are passed over, so a clique costs no square of its size.
"""

from __future__ import annotations

import numpy as np

LEAF, FAN = 16, 8
_CHUNK = 1 << 20  # bytes of bitmaps compared at once


class _Layer:
    """Nodes of one depth, in member order: each covers ``below[start:end]``."""

    def __init__(self, start, end, low, high, bits, hidden):
        self.start, self.end, self.low, self.high, self.bits, self.hidden = start, end, low, high, bits, hidden

    def above(self, owner: np.ndarray, fan: int) -> tuple[_Layer, np.ndarray]:
        """The next layer and the bucket of each of its nodes."""
        n = len(owner)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        at = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
        start = np.flatnonzero(at % fan == 0)
        return _Layer(start, np.r_[start[1:], n], np.minimum.reduceat(self.low, start),
                      np.maximum.reduceat(self.high, start), np.bitwise_or.reduceat(self.bits, start, axis=0),
                      np.maximum.reduceat(self.hidden, start)), owner[start]

    def may_link(self, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        low_a, low_b = self.low[a], self.low[b]
        fits = (self.high[b] * 100 >= percent * low_a) & (self.high[a] * 100 >= percent * low_b)
        a, b = a[fits], b[fits]
        common = np.bitwise_count(self.bits[a] & self.bits[b]).sum(axis=1, dtype=np.int64)
        most = np.minimum(self.hidden[a], self.hidden[b]) + common
        fits[fits] = most >= -(-percent * (low_a[fits] + low_b[fits]) // (100 + percent))
        return fits


def _pairs(layer: _Layer, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of what lies below the nodes of each pair, once; a node with itself gives i <= j."""
    wide = layer.end[b] - layer.start[b]
    count = (layer.end[a] - layer.start[a]) * wide
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    w = np.repeat(wide, count)
    i, j = np.repeat(layer.start[a], count) + k // w, np.repeat(layer.start[b], count) + k % w
    keep = i <= j
    return i[keep], j[keep]


def linked(bucket: np.ndarray, size: np.ndarray, bits: np.ndarray, hidden: np.ndarray, percent: int,
           verify=None) -> np.ndarray:
    """Per set, the first set of its bucket it is connected to over links (itself included).

    Sets of a bucket are neighbours. ``bits``: one row of 64-bit words per set; ``hidden``: tokens of
    the set that its bits may not show. ``verify(i, j)``: the pairs that are links, where bits and
    hidden tokens alone cannot tell.
    """
    n = len(size)
    label = np.arange(n)
    if n < 2:
        return label
    members = _Layer(None, None, size, size, bits, hidden)
    layer, owner = members.above(bucket, LEAF)
    layers = [layer]
    while len(np.unique(owner)) < len(owner):
        layer, owner = layer.above(owner, FAN)
        layers.append(layer)
    step = max(16, _CHUNK // (8 * bits.shape[1]))

    def one_label(depth):
        low, high = label, label
        for layer in layers[:depth + 1]:
            low, high = np.minimum.reduceat(low, layer.start), np.maximum.reduceat(high, layer.start)
        return low, high

    def join(i, j):
        nonlocal label
        while True:
            x, y = label[i], label[j]
            differ = x != y
            if not differ.any():
                return
            x, y = x[differ], y[differ]
            small = np.minimum(x, y)
            np.minimum.at(label, x, small)
            np.minimum.at(label, y, small)
            while (label[label] != label).any():
                label = label[label]

    def visit(depth, a, b):
        layer = layers[depth]
        per_chunk = max(1, step // (LEAF * LEAF)) if depth == 0 else step
        for at in range(0, len(a), per_chunk):
            x, y = a[at:at + per_chunk], b[at:at + per_chunk]
            if at or depth < len(layers) - 1:
                low, high = one_label(depth)
                apart = (low[x] != high[x]) | (low[y] != high[y]) | (low[x] != low[y])
                x, y = x[apart], y[apart]
            fits = layer.may_link(x, y, percent)
            x, y = x[fits], y[fits]
            if not len(x):
                continue
            if depth:
                visit(depth - 1, *_pairs(layer, x, y))
                continue
            i, j = _pairs(layer, x, y)
            apart = (i != j) & (label[i] != label[j])
            i, j = i[apart], j[apart]
            fits = members.may_link(i, j, percent)
            i, j = i[fits], j[fits]
            if verify is not None and len(i):
                fits = verify(i, j)
                i, j = i[fits], j[fits]
            join(i, j)

    roots = np.arange(len(layers[-1].start))
    visit(len(layers) - 1, roots, roots)
    return label
