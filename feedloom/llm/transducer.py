"""A minimal acyclic transducer from byte strings to id lists, in one block of bytes that can be mapped.

Words arrive sorted; states with equal futures are shared as they are completed, so common endings are
stored once. Each arc carries the number of words before it in its state; the sum along a path is the
word's ordinal, and the ordinal finds the ids.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import struct
import tempfile
from collections.abc import Iterable

import numpy as np

_HEADER = struct.Struct("<4sIIII")
_MAGIC = b"FSTL"
STEM, MOST_STEMS = 4, 20_000


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final = False
        self.number = -1
        self.words = 0


def _share(state: _State, register: dict) -> _State:
    """The registered state with the same future as ``state``."""
    key = (state.final, tuple((label, id(target)) for label, target in state.arcs.items()))
    known = register.get(key)
    if known is not None:
        return known
    state.words = state.final + sum(target.words for target in state.arcs.values())
    register[key] = state
    return state


def compile_transducer(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """Bytes of the transducer; ``entries`` may be in any order, the first of equal words counts."""
    ids_of: dict[bytes, list[int]] = {}
    for word, ids in entries:
        ids_of.setdefault(word, ids)
    register: dict = {}
    root = _State()
    path = [root]
    before = b""
    for word in sorted(ids_of):
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        for depth in range(len(path) - 1, common, -1):
            path[depth - 1].arcs[before[depth - 1]] = _share(path[depth], register)
        del path[common + 1:]
        for byte in word[common:]:
            state = _State()
            path[-1].arcs[byte] = state
            path.append(state)
        path[-1].final = True
        before = word
    for depth in range(len(path) - 1, 0, -1):
        path[depth - 1].arcs[before[depth - 1]] = _share(path[depth], register)

    states, stack = [], [root]
    while stack:
        state = stack.pop()
        if state.number < 0:
            state.number = len(states)
            states.append(state)
            stack.extend(state.arcs.values())
    labels, targets, skipped, starts = bytearray(), [], [], [0]
    for state in states:
        passed = int(state.final)
        for label, target in sorted(state.arcs.items()):
            labels.append(label)
            targets.append(target.number)
            skipped.append(passed)
            passed += target.words
        starts.append(len(labels))
    id_lists = [ids_of[word] for word in sorted(ids_of)]
    offsets = np.cumsum([0, *map(len, id_lists)])
    return b"".join((
        _HEADER.pack(_MAGIC, len(states), len(labels), len(id_lists), int(offsets[-1])),
        np.array(starts, "<u4").tobytes(), np.array(targets, "<u4").tobytes(), np.array(skipped, "<u4").tobytes(),
        offsets.astype("<u4").tobytes(), np.array([i for ids in id_lists for i in ids], "<u4").tobytes(),
        np.array([state.final for state in states], "u1").tobytes(), bytes(labels)))


class Transducer:
    """Looks words up in a mapped file; the arrays are views, only touched pages are read."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.file = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        magic, n_states, n_arcs, n_words, n_ids = _HEADER.unpack_from(self.file)
        if magic != _MAGIC:
            raise ValueError(f"{path} is no transducer")
        self.n_states, self.n_words = n_states, n_words
        view, at = memoryview(self.file), _HEADER.size
        fields = []
        for count in (n_states + 1, n_arcs, n_arcs, n_words + 1, n_ids):
            fields.append(view[at:at + 4 * count].cast("I"))
            at += 4 * count
        self.starts, self.targets, self.skipped, self.offsets, self.ids = fields
        self.final = view[at:at + n_states]
        self.labels = at + n_states
        self.stems: dict[bytes, tuple[int, int]] = {}
        # the arcs as arrays, for many words at once: state and label in one ascending key
        owner = np.repeat(np.arange(n_states), np.diff(np.asarray(self.starts)))
        self.arcs = np.r_[256 * owner + np.frombuffer(self.file, np.uint8, n_arcs, self.labels), 1 << 62]

    def ordinal(self, word: bytes) -> int:
        """Place of the word among all words, or -1."""
        state = total = 0
        find, base = self.file.find, self.labels
        known = self.stems.get(word[:STEM])
        if known is not None:
            state, total = known
            if state < 0:
                return -1
        for at in range(0 if known is None else STEM, len(word)):
            if at == STEM:
                self._remember(word[:STEM], state, total)
            arc = find(word[at:at + 1], base + self.starts[state], base + self.starts[state + 1])
            if arc < 0:
                if at < STEM <= len(word):
                    self._remember(word[:STEM], -1, 0)
                return -1
            total += self.skipped[arc - base]
            state = self.targets[arc - base]
        return total if self.final[state] else -1

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """``ordinal`` of every word: all words take a step together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        targets, skipped, final = np.asarray(self.targets), np.asarray(self.skipped), np.asarray(self.final)
        out = np.full(len(words), -1)
        rows = np.arange(len(words))
        state = total = np.zeros(len(words), np.int64)
        step = 0
        while len(rows):
            ended = sizes[rows] == step
            done = ended & (final[state] == 1)
            out[rows[done]] = total[done]
            rows, state, total = rows[~ended], state[~ended], total[~ended]
            keys = 256 * state + letters[starts[rows] + step]
            arc = np.searchsorted(self.arcs, keys)
            there = self.arcs[arc] == keys
            rows, arc, total = rows[there], arc[there], total[there]
            state, total = targets[arc].astype(np.int64), total + skipped[arc]
            step += 1
        return out

    def _remember(self, stem: bytes, state: int, total: int) -> None:
        """Where the first bytes of a word lead, so that the next word with them starts there."""
        if len(self.stems) >= MOST_STEMS:
            self.stems.clear()
        self.stems[stem] = state, total

    def get(self, word: bytes) -> list[int] | None:
        place = self.ordinal(word)
        return None if place < 0 else self.ids[self.offsets[place]:self.offsets[place + 1]].tolist()


def mapped(block: bytes) -> Transducer:
    """Maps ``block`` from a file of this machine that all workers share; made anew where it is missing."""
    path = os.path.join(tempfile.gettempdir(), f"lexicon-{hashlib.sha256(block).hexdigest()[:32]}.fst")
    if not os.path.exists(path):
        handle, part = tempfile.mkstemp(dir=os.path.dirname(path))
        with os.fdopen(handle, "wb") as file:
            file.write(block)
        os.replace(part, path)
    return Transducer(path)
