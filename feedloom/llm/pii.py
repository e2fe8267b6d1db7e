"""Personal data: base patterns, and a linear-chain conditional random field over word-shape features.

Base spans, per kind, are the leftmost non-overlapping matches of a fixed pattern; a match that fails its
check is dropped and the search goes on after it (no retry inside it). Positions are code points, end
exclusive. Kinds and patterns (fixed values):

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, every part at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 16 to 19 digits that pass the Luhn check
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 8 to 15 digits

The field adds spans that the patterns miss (a phone number without its ``+``, an address written with
other separators). Units are tokens ``[A-Za-z0-9]+|[^\\sA-Za-z0-9]``; labels are ``O`` and the four kinds;
features are the lower-cased token (hashed), its shape (``Xx9`` classes, runs cut to two), its short shape,
its length, white space before it, and the shapes of two tokens on each side. The labelled table is made
from the corpus: windows of ``WINDOW`` tokens around base spans and elsewhere, labelled by the base spans,
of which at most ``TRAIN_WINDOWS`` are taken in the order of a hash (the documented bound of the sample).
Training maximises the conditional likelihood (forward-backward over the batch of windows, AdaGrad) on the
driver; the weights, some 2 MB whatever the corpus, go to the tasks with the job. Decoding is Viterbi over
whole texts: tokens whose emission makes ``O`` better than any other label between any neighbours have that
label in every best path, and the stretches between them are decoded together in numpy. A decoded run of one kind that overlaps no base
span of any kind, and holds the least shape of its kind (an ``@`` inside, four digit groups, 13 or 7 digits;
``SHAPE_OF``), is added; base spans always stay.

Defined cases: a null text is empty (no spans); repeated rows give equal rows; very long texts are decoded
whole; an empty table gives an empty result and a model of zero weights (which adds nothing); only the id
and text columns are read, so extra columns, also with clashing names, do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready, stored

# Fixed values of the contract: kinds in their order, and patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": regex.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": regex.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": regex.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": regex.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LABELS = ("O",) + KINDS
TOKEN = regex.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
WINDOW = 48
TRAIN_WINDOWS = 6000
HASHED = 1 << 16
SHAPES = 1 << 12
ROUNDS = 60
BATCH_TOKENS = 100_000  # texts decoded together have about so many tokens
KNOWN_TOKENS = 200_000  # tokens a task remembers
MARGIN = 1e-6  # by which ``O`` must be better to be settled at once, far beyond any rounding


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    digits = sum(c.isdigit() for c in found)
    if kind == "card":
        return 16 <= digits <= 19 and _luhn("".join(c for c in found if c.isdigit()))
    return 8 <= digits <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in the order of kinds, then start."""
    out = []
    for kind in KINDS:
        out += [(kind, m.start(), m.end()) for m in PATTERNS[kind].finditer(text) if _valid(kind, m.group())]
    return out


def _shape(token: str, short: bool) -> str:
    out = []
    for c in token:
        s = "X" if "A" <= c <= "Z" else "x" if "a" <= c <= "z" else "9" if "0" <= c <= "9" else c
        if not out or out[-1] != s or (not short and len(out) > 1 and out[-2] != s):
            out.append(s)
    return "".join(out)


def _bucket(text: str, size: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") % size


@functools.cache
def _characters() -> tuple[np.ndarray, re.Pattern]:
    """Kind of every code point (0 white space of ``TOKEN``, 1 letter or digit, 2 other), and ``TOKEN`` with its
    white space spelled out, for the quicker module."""
    spaces = regex.findall(r"\s", "".join(map(chr, range(0x110000))))
    kinds = np.full(0x110000, 2, np.uint8)
    kinds[[ord(c) for c in spaces]] = 0
    kinds[[c for c in range(128) if chr(c).isalnum()]] = 1
    return kinds, re.compile(f"[A-Za-z0-9]+|[^A-Za-z0-9{re.escape(''.join(spaces))}]")


def token_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens of a text."""
    kinds = np.zeros(len(text) + 2, np.uint8)
    kinds[1:-1] = _characters()[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    word, other = kinds == 1, kinds[1:-1] == 2
    starts = np.flatnonzero(other | (word[1:-1] & ~word[:-2]))
    ends = np.flatnonzero(other | (word[1:-1] & ~word[2:])) + 1
    return starts, ends


class Features:
    """Per token: hashed word, shape, short shape, length and space feature ids; neighbours come from shifts."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.own = np.zeros((1 << 10, 3), dtype=np.int64)
        self.shapes: dict[str, int] = {}

    def _shape_bucket(self, text: str) -> int:
        got = self.shapes.get(text)
        if got is None:
            if len(self.shapes) > KNOWN_TOKENS:
                self.shapes.clear()
            got = self.shapes[text] = _bucket(text, SHAPES)
        return got

    def _row(self, token: str) -> int:
        """Place of the token's features in ``own``."""
        row = len(self.rows)
        if row == len(self.own):
            self.own = np.concatenate((self.own, np.zeros_like(self.own)))
        plain = token.isascii() and token.islower() and token.isalpha()
        shape, short = ("x", "x") if plain else (_shape(token, False), _shape(token, True))
        self.own[row] = _bucket("w" + token.lower(), HASHED), self._shape_bucket("s" + shape), self._shape_bucket("t" + short)
        self.rows[token] = row
        return row

    def of(self, text: str):
        """(starts, ends, ids (n, 9)) of a text's tokens."""
        starts, ends = token_bounds(text)
        n = len(starts)
        if n == 0:
            return starts, ends, np.zeros((0, 9), dtype=np.int64)
        tokens = _characters()[1].findall(text)
        if len(self.rows) > KNOWN_TOKENS:  # between texts only: the rows of one text stay valid
            self.rows.clear()
            self.own = self.own[:1 << 10]
        for token in set(tokens).difference(self.rows):
            self._row(token)
        own = self.own[np.fromiter(map(self.rows.__getitem__, tokens), np.int64, n)]
        ids = np.empty((n, 9), dtype=np.int64)
        ids[:, :3] = own
        np.minimum(ends - starts, 12, out=ids[:, 3])
        ids[0, 4] = 1
        ids[1:, 4] = starts[1:] > ends[:-1]
        around = np.full(n + 4, SHAPES, dtype=np.int64)
        around[2:-2] = own[:, 1]
        for column, shift in ((5, 0), (6, 1), (7, 3), (8, 4)):
            ids[:, column] = around[shift:n + shift]
        return starts, ends, ids


class Model:
    """Weights of the field: one table per feature column, and transitions (start row last)."""

    SIZES = (HASHED, SHAPES, SHAPES, 13, 2, SHAPES + 1, SHAPES + 1, SHAPES + 1, SHAPES + 1)

    def __init__(self, tables=None, transitions=None):
        k = len(LABELS)
        self.tables = tables or [np.zeros((s, k)) for s in self.SIZES]
        self.transitions = np.zeros((k + 1, k)) if transitions is None else transitions

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(ids.shape[:-1] + (len(LABELS),))
        for c, table in enumerate(self.tables):
            out += table[ids[..., c]]
        return out


def _log_sum(a, axis):
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(windows: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS, rate: float = 0.5) -> Model:
    """Conditional likelihood of labelled windows (ids (n, 9), labels (n,)), batch forward-backward, AdaGrad."""
    model = Model()
    if not windows:
        return model
    k, b = len(LABELS), len(windows)
    length = max(len(w[1]) for w in windows)
    ids = np.zeros((b, length, 9), dtype=np.int64)
    labels = np.zeros((b, length), dtype=np.int64)
    mask = np.zeros((b, length), dtype=bool)
    for r, (i, y) in enumerate(windows):
        ids[r, :len(y)], labels[r, :len(y)], mask[r, :len(y)] = i, y, True
    known = [ids[..., c][mask] for c in range(9)]
    squares = [np.full(t.shape, 1e-6) for t in model.tables] + [np.full(model.transitions.shape, 1e-6)]
    for _ in range(rounds):
        e = model.emissions(ids)
        t, start = model.transitions[:k], model.transitions[k]
        # windows last: every step then works on long rows
        et, live = np.ascontiguousarray(e.transpose(1, 2, 0)), np.ascontiguousarray(mask.T)
        alpha = np.zeros((length, k, b))
        alpha[0] = start[:, None] + et[0]
        for j in range(1, length):
            step = _log_sum(alpha[j - 1][:, None] + t[:, :, None], 0) + et[j]
            alpha[j] = np.where(live[j], step, alpha[j - 1])
        beta = np.zeros((length, k, b))
        for j in range(length - 2, -1, -1):
            step = _log_sum(t[:, :, None] + (et[j + 1] + beta[j + 1])[None], 1)
            beta[j] = np.where(live[j + 1], step, beta[j + 1])
        alpha, beta = (np.ascontiguousarray(x.transpose(2, 0, 1)) for x in (alpha, beta))
        z = _log_sum(alpha[:, -1], 1)
        marginal = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        gold = np.eye(k)[labels] * mask[..., None]
        diff = gold - marginal
        grads, missing = [], diff[mask].T.copy()
        for c, table in enumerate(model.tables):
            g = np.stack([np.bincount(known[c], missing[y], len(table)) for y in range(k)], axis=1)
            grads.append(g - 1e-4 * table)
        pair = alpha[:, :-1, :, None] + t[None, None]
        pair += (e[:, 1:] + beta[:, 1:])[:, :, None, :]
        pair -= z[:, None, None, None]
        np.exp(pair, out=pair)
        both = (mask[:, 1:] & mask[:, :-1])[..., None, None]
        pair *= both
        expected = pair.sum((0, 1))
        seen = np.zeros((k, k))
        np.add.at(seen, (labels[:, :-1][both[..., 0, 0]], labels[:, 1:][both[..., 0, 0]]), 1)
        gt = np.zeros_like(model.transitions)
        gt[:k] = seen - expected
        gt[k] = (gold[:, 0] - marginal[:, 0]).sum(0)
        grads.append(gt)
        for p, (param, g) in enumerate(zip(model.tables + [model.transitions], grads)):
            squares[p] += g * g
            param += rate * g / np.sqrt(squares[p])
    return model


def _settled(model: Model, e: np.ndarray) -> np.ndarray:
    """Whether ``O`` beats every other label at a token whatever its neighbours, so that all best paths have it."""
    k = len(LABELS)
    t = model.transitions
    into = (t - t[:, :1]).max(0)
    out = np.maximum((t[:k] - t[0]).max(1), 0)
    return (e[:, :1] - e[:, 1:] >= (into + out)[1:] + MARGIN).all(1)


def viterbi(model: Model, batch: list[np.ndarray]) -> list[np.ndarray]:
    """Best label paths of a batch of token feature arrays, decoded together.

    Stretches between settled tokens do not depend on one another. The longest come first, so that those not
    ended at a step are the first ones.
    """
    k = len(LABELS)
    lengths = np.array([len(ids) for ids in batch], dtype=np.int64)
    after = np.cumsum(lengths)
    paths = np.zeros(int(lengths.sum()), dtype=np.int64)
    if len(paths):
        e = model.emissions(np.concatenate(batch))
        t, start = model.transitions[:k], model.transitions[k]
        first, last = np.zeros((2, len(paths)), dtype=bool)
        first[(after - lengths)[lengths > 0]] = last[after[lengths > 0] - 1] = True
        open_ = ~_settled(model, e)
        begins = np.flatnonzero(open_ & (first | np.r_[True, ~open_[:-1]]))
        ends = np.flatnonzero(open_ & (last | np.r_[~open_[1:], True]))
        order = np.argsort(begins - ends, kind="stable")
        begins, ends = begins[order], ends[order]
        # how many stretches have a token at each step
        live = len(begins) - np.searchsorted(np.sort(ends - begins), np.arange((ends - begins).max(initial=-1) + 1))
        score = np.where(first[begins, None], start, t[0]) + e[begins]
        back = np.zeros((len(paths), k), dtype=np.int8)
        for j, m in enumerate(live[1:].tolist(), 1):
            total = score[:m, :, None] + t[None]
            at = begins[:m] + j
            back[at] = total.argmax(1)
            score[:m] = total.max(1) + e[at]
        label = np.where(last[ends, None], score, score + t[:, 0]).argmax(1)
        for j in range(len(live) - 1, 0, -1):
            at = begins[:live[j]] + j
            paths[at] = label[:live[j]]
            label[:live[j]] = back[at, label[:live[j]]]
        paths[begins] = label
    return np.split(paths, after[:-1]) if batch else []


def _labelled(text: str, features: Features):
    """Token ids and base labels of a text."""
    spans = base_spans(text)
    starts, ends, ids = features.of(text)
    labels = np.zeros(len(starts), dtype=np.int64)
    for kind, a, z in spans:
        labels[(starts >= a) & (ends <= z)] = LABELS.index(kind)
    return spans, starts, ends, ids, labels


def _windows(batches, light: bool = False):
    """Labelled windows of each text; ``light`` gives keys and ids of documents alone (for choosing)."""
    features = Features()
    for frame in batches:
        keys, ids_out, labels_out, docs = [], [], [], []
        for doc_id, text in zip(frame["doc_id"], frame["text"]):
            if light:
                spans, (starts, _) = base_spans(text), token_bounds(text)
            else:
                spans, starts, _, ids, labels = _labelled(text, features)
            n = len(starts)
            if n == 0:
                continue
            seed = _bucket(f"{doc_id}:{text[:0]}{n}", 1 << 62)
            centres = [int(np.searchsorted(starts, a)) for _, a, _ in spans] + [seed % n]
            for c in centres:
                lo = max(0, min(c - WINDOW // 2, n - WINDOW))
                keys.append(_bucket(f"{seed}:{lo}", 1 << 62))
                docs.append(doc_id)
                ids_out.append(b"" if light else ids[lo:lo + WINDOW].astype("<i8").tobytes())
                labels_out.append(b"" if light else labels[lo:lo + WINDOW].astype("<i8").tobytes())
        yield pd.DataFrame({"key": pd.array(keys, dtype="int64"), "ids": ids_out, "labels": labels_out,
                            "doc_id": pd.array(docs, dtype="Int64")})


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """The field trained on at most ``TRAIN_WINDOWS`` labelled windows of ``docs``, taken by hash order."""
    python_ready(docs.sparkSession)
    prepared = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                           F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    schema = "key long, ids binary, labels binary, doc_id long"
    # keys first (8 bytes a window reach the driver from each task), then the windows of the chosen documents
    chosen = prepared.mapInPandas(lambda b: _windows(b, light=True), schema) \
        .select("key", "doc_id").orderBy("key").limit(TRAIN_WINDOWS)
    chosen = stored(docs.sparkSession, chosen, "pii-windows", slim=True)
    keys = chosen.select("key").distinct()
    ids = chosen.select(F.col("doc_id").alias("_chosen_id")).distinct()
    rows = prepared.join(ids, prepared["doc_id"].eqNullSafe(ids["_chosen_id"]), "left_semi") \
        .mapInPandas(_windows, schema).join(F.broadcast(keys), "key", "left_semi") \
        .orderBy("key", "ids", "labels").limit(TRAIN_WINDOWS).collect()
    return train([(np.frombuffer(r.ids, dtype="<i8").reshape(-1, 9), np.frombuffer(r.labels, dtype="<i8"))
                  for r in rows])


# What a decoded run must hold to be a span of its kind (fixed values of this method).
SHAPE_OF = {"email": regex.compile(r"[^@\s]@[^@\s]"), "ip": regex.compile(r"[0-9]+(?:[^0-9]+[0-9]+){3}"),
            "card": regex.compile(r"(?:[0-9][^0-9]{0,2}){13}"), "phone": regex.compile(r"(?:[0-9][^0-9]{0,2}){7}")}


def _added(spans, starts, ends, path, text):
    """Runs of one kind in a decoded path that overlap no base span and have the shape of their kind."""
    out = []
    changes = np.flatnonzero(path[1:] != path[:-1]) + 1
    for j, z in zip(np.r_[0, changes].tolist(), np.r_[changes, len(path)].tolist()):
        if j == z or path[j] == 0:
            continue
        a, b = int(starts[j]), int(ends[z - 1])
        kind = LABELS[path[j]]
        if not any(a < e and s < b for _, s, e in spans) and SHAPE_OF[kind].search(text, a, b):
            out.append((kind, a, b))
    return out


def _find(model: Model):
    def run(batches):
        features = Features()
        for frame in batches:
            base, added, group, size = [], [], [], 0
            texts = list(frame["text"])
            for r, text in enumerate(texts):
                group.append((base_spans(text), text, *features.of(text)))
                size += len(group[-1][2])
                if size >= BATCH_TOKENS or r + 1 == len(texts):
                    paths = viterbi(model, [ids for *_, ids in group])
                    for (spans, found_in, starts, ends, _), path in zip(group, paths):
                        base.append([{"kind": k, "start": a, "end": z} for k, a, z in spans])
                        added.append([{"kind": k, "start": a, "end": z}
                                      for k, a, z in _added(spans, starts, ends, path, found_in)])
                    group, size = [], 0
            yield pd.DataFrame({"doc_id": frame["doc_id"], "base": base, "added": added})
    return run


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_pii(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, base, added): base spans and spans the field adds, each (kind, start, end)."""
    python_ready(docs.sparkSession)
    prepared = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                           F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return prepared.mapInPandas(_find(model), f"doc_id long, base {SPANS}, added {SPANS}")


def joined(spans):
    """``kind:start:end`` of spans, by kind in the listed order, then start and end, comma-joined."""
    rank = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    keyed = F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("r"), s["start"].alias("start"),
                                                  s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
