"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Votes are counted by
pattern over the whole corpus (at most 3 to the number of labellers rows), and expectation-maximisation
on these counts estimates the share of good documents and each labeller's accuracy on either class,
without any true label. The posterior of a pattern is the soft label of its documents. A linear scorer
over hashed word, shape and ending features and the share of stuttered words is trained on a bounded sample of documents, chosen by a
hash of the id with as many of each posterior class as there are, up to ``MOST_TRAINING`` each. The
scorer reads whole texts of all documents; those below ``CUTOFF`` are rejected.

Null and empty texts have no words, get bad votes throughout, and score 0. Repeated rows score alike.
With no document, or none of a class, the pattern's posterior is the score. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready
from feedloom.llm.pieces import Pieces

DIMENSIONS = 1 << 16
STUTTER = 0  # feature of repeated words; hashed features share the others
MOST_TRAINING = 3_000
CUTOFF = 0.5
KNOWN_WORDS = 100_000  # words a task remembers
ABSTAIN, BAD, GOOD = 0, 1, 2
_SYMBOL = re.compile(r"[#*$%&|<>{}\\^~]")
_SHOUT = re.compile(r"[!?]{2}")
_ODD, _UPPER, _LOUD, _STOP, _LOWER = 1, 2, 4, 8, 16


def _plain(word: str) -> tuple[str, str] | None:
    """Shape of the letters of an ordinary word, in lower case or with one capital before others, and the
    sign that ends it, if any; None for all other words."""
    body, end = (word[:-1], word[-1]) if word[-1] in ".,;:?!" else (word, "")
    if body.isalpha():
        if body.islower():
            return "a", end
        if body[0].isupper() and body[1:].islower():
            return "Aa", end
    return None


def _marks(word: str) -> int:
    """What the labellers look at in a word."""
    if _plain(word):
        return _LOWER | _STOP * (word[-1] in ".?!")
    letters = [c for c in word if c.isalpha()]
    upper = sum(c.isupper() for c in letters)
    return (_ODD * (not any(map(str.isalnum, word)) or bool(_SYMBOL.search(word)))
            | _UPPER * (len(letters) > 1 and upper == len(letters)) | _LOUD * bool(_SHOUT.search(word))
            | _STOP * (word[-1] in ".?!") | _LOWER * (len(letters) > upper and upper <= 1))


def _prose(s: dict) -> bool:
    return s["odd"] < 0.05 and s["upper"] < 0.1 and s["loud"] < 0.02 and s["lines"] < 0.1 and s["again"] < 0.05


# Labellers: from the shares of the marks, n words, mean word length, share of distinct words and share
# of repeated lines to a vote. Most know one kind of fault and abstain otherwise.
LABELLERS = {
    "symbols": lambda s: BAD if s["odd"] > 0.25 else ABSTAIN,
    "capitals": lambda s: BAD if s["upper"] > 0.5 else ABSTAIN,
    "loud": lambda s: BAD if s["loud"] > 0.3 else ABSTAIN,
    "few_lower_case": lambda s: BAD if s["lower"] < 0.3 else ABSTAIN,
    "word_length": lambda s: BAD if s["length"] > 16 or s["length"] < 1.5 else ABSTAIN,
    "repeats": lambda s: BAD if s["lines"] > 0.5 or (s["distinct"] < 0.2 and 30 <= s["n"] < 1000) else ABSTAIN,
    "stutter": lambda s: BAD if s["again"] > 0.2 else ABSTAIN,
    "sentences": lambda s: GOOD if 0.01 <= s["stop"] and (s["stop"] <= 0.5 or s["n"] < 10) and s["odd"] < 0.1 else BAD if s["odd"] > 0.4 else ABSTAIN,
    "lower_case": lambda s: GOOD if s["lower"] > 0.7 and s["odd"] < 0.1 else ABSTAIN,
    "prose": lambda s: GOOD if _prose(s) else ABSTAIN,
}


def repeats(words: list[str]) -> float:
    """Share of words that repeat the one before."""
    return sum(map(eq, words, words[1:])) / max(1, len(words))


def vote_pattern(text: str | None, marks) -> int:
    """Votes of all labellers as one number in base 3."""
    text = text or ""
    words = text.split()
    n = len(words)
    m = np.fromiter(map(marks.__getitem__, words), np.uint8, n)
    lines = [line for line in text.split("\n") if line.strip()]
    share = lambda bit: float(np.count_nonzero(m & bit)) / max(1, n)
    s = {"n": n, "odd": share(_ODD), "upper": share(_UPPER), "loud": share(_LOUD), "stop": share(_STOP),
         "lower": share(_LOWER), "length": len("".join(words)) / max(1, n),
         "distinct": len(set(words)) / n if 30 <= n < 1000 else 1.0,  # looked at in texts of such lengths only
         "again": repeats(words),
         "lines": 1 - len(set(lines)) / len(lines) if lines else 0.0}
    pattern = 0
    for labeller in LABELLERS.values():
        pattern = 3 * pattern + (labeller(s) if n else BAD)
    return pattern


def votes_of(pattern: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        pattern, vote = divmod(pattern, 3)
        out.append(vote)
    return out[::-1]


def estimate(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], dict[str, tuple[float, float]]]:
    """Posterior of good per pattern, and per labeller its accuracy on good and on bad documents."""
    patterns = sorted(counts)
    if not patterns:
        return {}, {}
    votes = np.array([votes_of(p) for p in patterns])
    weight = np.array([counts[p] for p in patterns], float)
    good = (votes == GOOD).sum(axis=1) - (votes == BAD).sum(axis=1)
    posterior = np.clip(0.5 + good / (2.0 * len(LABELLERS)), 0.02, 0.98)
    for _ in range(rounds):
        likelihood = np.zeros((2, len(patterns)))
        for side, p in enumerate((1 - posterior, posterior)):
            w = weight * p
            likelihood[side] += np.log((w.sum() + 1) / (weight.sum() + 2))
            for j in range(votes.shape[1]):
                # One document's worth of belief in each vote, more in the right one.
                right = GOOD if side else BAD
                prior = np.array([1.0 + 2.0 * (v == right) for v in range(3)])
                table = np.array([w[votes[:, j] == v].sum() for v in range(3)]) + prior
                likelihood[side] += np.log(table / table.sum())[votes[:, j]]
        new = 1 / (1 + np.exp(np.clip(likelihood[0] - likelihood[1], -50, 50)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    accuracy = {}
    for j, name in enumerate(LABELLERS):
        rates = []
        for p, right in ((posterior, GOOD), (1 - posterior, BAD)):
            voted = (weight * p)[votes[:, j] != ABSTAIN].sum()
            rates.append(float((weight * p)[votes[:, j] == right].sum() / voted) if voted else 0.5)
        accuracy[name] = tuple(rates)
    return dict(zip(patterns, posterior.tolist())), accuracy


def _shape(word: str) -> str:
    """The kinds of characters of a word, runs once."""
    plain = _plain(word)
    if plain:
        return "".join(plain)
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:8])


def _hashed(feature: str) -> int:
    return 1 + xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % (DIMENSIONS - 1)


_often_hashed = functools.lru_cache(maxsize=20_000)(_hashed)  # shapes and endings come again and again


def features(word: str) -> tuple[int, int, int]:
    """Hashed features of a word: itself, its shape, its ending."""
    return _hashed("w:" + word.lower()), _often_hashed("s:" + _shape(word)), _often_hashed("e:" + word[-3:])


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 12, rate: float = 0.5) -> np.ndarray:
    """Weights and, last, the bias of logistic regression on (indices, shares, soft label) rows, by
    Adagrad on minibatches in a fixed order. Both classes weigh the same."""
    y = np.array([row[2] for row in rows])
    balance = np.where(y > 0.5, 0.5 / max(1e-9, (y > 0.5).mean()), 0.5 / max(1e-9, (y <= 0.5).mean()))
    w, g = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-6)
    order = np.random.default_rng(1)
    for _ in range(epochs):
        places = order.permutation(len(rows))
        for at in range(0, len(rows), 64):
            part = places[at:at + 64]
            index = np.concatenate([np.r_[rows[k][0], DIMENSIONS] for k in part])
            value = np.concatenate([np.r_[rows[k][1], 1.0] for k in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[k][0]) + 1 for k in part])
            margin = np.bincount(owner, w[index] * value, len(part))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]) * balance[part]
            used, place = np.unique(index, return_inverse=True)
            gradient = np.bincount(place, error[owner] * value) / len(part) + 1e-6 * w[used]
            g[used] += gradient * gradient
            w[used] -= rate * gradient / np.sqrt(g[used])
    return w


def _voted(batches):
    marks = Pieces(_marks, KNOWN_WORDS)
    for batch in batches:
        patterns = [vote_pattern(text.as_py(), marks) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(patterns, pa.int32())],
                                         names=[*batch.schema.names, "pattern"])


def _vectors(batches):
    known = Pieces(features, KNOWN_WORDS)
    for batch in batches:
        indices, values = [], []
        for text in batch.column("text"):
            words = (text.as_py() or "").split()
            index, count = np.unique(np.array([known[word] for word in words], np.int64).reshape(-1), return_counts=True)
            indices.append(np.r_[index, STUTTER]), values.append(np.r_[count / max(1, len(words)), repeats(words)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("pattern"), pa.array(indices, pa.list_(pa.int32())),
             pa.array(values, pa.list_(pa.float32()))], names=["doc_id", "pattern", "i", "v"])


def training_sample(rows: DataFrame, share: dict[int, float]) -> DataFrame:
    """(doc_id, pattern, i, v) of that share of each pattern's (doc_id, text) rows, chosen by a hash.

    Votes, choice and vectors are one step: two would take two Python workers for every task, and an
    executor keeps them beside the workers of later stages.
    """
    def run(batches):
        def chosen():
            for batch in _voted(batches):
                patterns = batch.column("pattern").to_pylist()
                yield batch.filter(pa.array([x < share[p] for x, p in zip(batch.column("place").to_pylist(), patterns)], pa.bool_()))
        return _vectors(chosen())

    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("train")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.withColumn("place", place).filter(F.col("place") < max(share.values())) \
        .mapInArrow(run, "doc_id bigint, pattern int, i array<int>, v array<float>")


def fit(docs: DataFrame) -> dict:
    """The model: posterior per vote pattern, labeller accuracies, scorer weights (None without both classes)."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    slim = rows.mapInArrow(_voted, "doc_id bigint, text string, pattern int").select("pattern")
    counts = {row.pattern: row["count"] for row in slim.groupBy("pattern").count().collect()}
    posterior, accuracy = estimate(counts)
    model = {"posterior": posterior, "accuracy": accuracy, "weights": None}
    sizes = [sum(n for p, n in counts.items() if (posterior[p] > 0.5) == side) for side in (False, True)]
    if min(sizes) == 0:
        return model
    sample = training_sample(rows, {p: min(1.0, MOST_TRAINING / sizes[posterior[p] > 0.5]) for p in counts})
    # As columns, a few bytes per feature of a bounded number of documents; ordered, so that reruns agree.
    columns = sample.orderBy("doc_id", "pattern", "i", "v").toArrow()
    data = [(i.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(float), posterior[p.as_py()])
            for p, i, v in zip(columns.column("pattern"), columns.column("i"), columns.column("v"))]
    if data:
        model["weights"] = train(data)
    return model


def _scorer(m: dict):
    """A function from a text to its score."""
    w, marks = m["weights"], Pieces(_marks, KNOWN_WORDS)
    weights = [] if w is None else w.tolist()

    def weight(word: str) -> float:
        itself, shape, ending = features(word)
        return weights[itself] + weights[shape] + weights[ending]

    weigh = Pieces(weight, KNOWN_WORDS)

    def of(text: str | None) -> float:
        words = (text or "").split()
        if not words:
            return 0.0
        if w is None:
            return m["posterior"].get(vote_pattern(text, marks), 0.5)
        total = np.fromiter(map(weigh.__getitem__, words), float, len(words)).mean() + w[STUTTER] * repeats(words) + w[-1]
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))
    return of


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every document; 1: good."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        of = _scorer(shared.value)
        for batch in batches:
            scores = [of(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def keep(docs: DataFrame, model: dict) -> DataFrame:
    """The documents that the scorer does not reject, with all their columns, in one pass."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        of = _scorer(shared.value)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([of(value.as_py()) >= CUTOFF for value in text], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
