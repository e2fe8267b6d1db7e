"""Toxicity by compression distance: windows of a text are compressed with a zstandard dictionary of
toxic and one of ordinary text, and the lengths compared.

Both dictionaries hold the same base, trained on ordinary text, so that chance matches cancel; before it
stands a part trained on toxic and on ordinary text respectively, from the words that are clearly more
frequent on that side. A text's statistics of (ordinary length - toxic length) over its windows are
calibrated to a probability by logistic regression on training documents.

Learned from a bounded sample of training rows, ``MOST_TOXIC`` and ``MOST_ORDINARY`` documents chosen by
a hash of their id, equal texts of a class once; their characteristic words are all taken, in segments of
about ``SEGMENT`` bytes. Whole texts of all documents are scored. Null and empty texts have no windows and
get the score of statistics that are all zero. Without training rows of either class every score is
the share of the other. Repeated rows are all scored. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready, stored

MOST_TOXIC, MOST_ORDINARY = 3_000, 9_000
WINDOW, LEVEL = 96, 9
BASE_BYTES, OWN_BYTES = 8_192, 2_048
LEAST_Z, LEAST_RATIO, MOST_WORDS = 4.5, 8.0, 400
MOST_WINDOWS, SEGMENT = 20_000, 4_000


def windows(text: str | None) -> list[bytes]:
    """Consecutive windows of a text, cut at the first space after ``WINDOW`` bytes."""
    raw, at, out = (text or "").encode("utf-8", "surrogatepass"), 0, []
    while at < len(raw):
        end = min(len(raw), at + WINDOW)
        space = raw.find(b" ", end, end + 64) if end < len(raw) else -1
        end = space if space > 0 else end
        out.append(raw[at:end])
        at = end
    return out


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    data.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)


def statistics(text: str | None, ordinary, toxic) -> list[float]:
    """What the window differences of a text look like."""
    d = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)], float)
    n = len(d)
    if not n:
        return [0.0] * 8
    top = np.sort(d)[::-1]
    return [d.mean(), top[0], top[:3].mean(), (d >= 2).mean(), (d >= 4).mean(), d.sum() / math.sqrt(n), math.log(n),
            (d >= 3).sum() / math.sqrt(n)]


def _trained(samples: list[bytes], size: int, pad: bytes) -> bytes:
    """A dictionary of exactly ``size`` bytes; too few samples are taken as they are."""
    try:
        content = zstandard.train_dictionary(size, samples, d=6, k=24, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        content = b" ".join(dict.fromkeys(word for sample in samples for word in sample.split()))
    content = content[-size:]
    return (pad * (size // max(1, len(pad)) + 1))[:size - len(content)] + content if pad else content


def training_rows(docs: DataFrame, labels: DataFrame, train) -> DataFrame:
    """(doc_id, text, toxic) of the bounded training sample. Its ids are few and broadcast. Of documents
    with the same whole text one stays: copies would pass their words off as typical of a class."""
    known = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(train)
    order = F.xxhash64("doc_id", F.lit("sample"))
    some = known.filter("toxic = 1").orderBy(order, "doc_id").limit(MOST_TOXIC) \
        .unionAll(known.filter("toxic != 1").orderBy(order, "doc_id").limit(MOST_ORDINARY))
    some = stored(docs.sparkSession, some.withColumn("toxic", (F.col("toxic") == 1).cast("int")), "toxic-sample")
    found = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    whole = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return found.groupBy(whole.alias("whole"), "toxic").agg(F.min(F.struct("doc_id", "text")).alias("d")) \
        .select("d.doc_id", "d.text", "toxic")


def _contrast(sample: DataFrame, n_toxic: int, n_ordinary: int) -> tuple[list[str], list[str]]:
    """Words over-represented in toxic and in ordinary documents: at most ``MOST_WORDS`` each."""
    word = F.explode(F.array_distinct(F.split(F.col("text"), r"\s+")))
    counts = sample.select("toxic", word.alias("word")).filter("word != ''").groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    p = (F.col("a") + F.col("b")) / (n_toxic + n_ordinary)
    z = (F.col("a") / n_toxic - F.col("b") / n_ordinary) / F.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_ordinary) + 1e-12)
    rows = counts.withColumn("z", z)
    toxic = rows.filter((F.col("z") >= LEAST_Z) & (F.col("a") * n_ordinary >= LEAST_RATIO * F.col("b") * n_toxic))
    ordinary = rows.filter((F.col("z") <= -LEAST_Z / 2) & (F.col("b") * n_toxic >= LEAST_RATIO / 2 * F.col("a") * n_ordinary))
    take = lambda df, order: [r.word for r in df.orderBy(order, "word").limit(MOST_WORDS).collect()]
    return take(toxic, F.desc("z")), take(ordinary, F.col("z"))


def segments_of(text: str | None, words: frozenset[bytes]) -> list[bytes]:
    """All words of a text that are in ``words``, in order, cut after the word that reaches ``SEGMENT`` bytes."""
    out, held, size = [], [], 0
    for word in (text or "").encode("utf-8", "surrogatepass").split():
        if word in words:
            held.append(word)
            size += len(word) + 1
            if size > SEGMENT:
                out.append(b" ".join(held))
                held, size = [], 0
    return out + [b" ".join(held)] if held else out


def fit(docs: DataFrame, labels: DataFrame, train) -> dict:
    """The model: two dictionaries, calibration weights. ``train``: condition on ``doc_id``."""
    spark = docs.sparkSession
    python_ready(spark)
    classes = dict(labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
                   .filter(train).groupBy((F.col("toxic") == 1).alias("t")).count().collect())
    share = classes.get(True, 0) / max(1, sum(classes.values()))
    sample = stored(spark, training_rows(docs, labels, train), "toxic-texts")
    found = dict(sample.groupBy("toxic").count().collect())
    n_toxic, n_ordinary = found.get(1, 0), found.get(0, 0)
    if not n_toxic or not n_ordinary:
        return {"share": share, "weights": None}
    toxic_words, ordinary_words = (frozenset(w.encode("utf-8", "surrogatepass") for w in words)
                                   for words in _contrast(sample, n_toxic, n_ordinary))

    def segments(batches):
        """Per document, all its over-represented words in order, and for ordinary text its windows."""
        for batch in batches:
            kinds, orders, out = [], [], []
            for number, text, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))):
                keep = toxic_words if toxic else ordinary_words
                found = [(toxic, piece) for piece in segments_of(text, keep)]
                if not toxic:
                    found += [(2, w) for w in windows(text)]
                for k, (kind, piece) in enumerate(found):
                    kinds.append(kind), out.append(piece)
                    orders.append(hashlib.blake2b(f"{number}:{k}".encode(), digest_size=8).digest())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(orders, pa.binary()),
                                              pa.array(out, pa.binary())], names=["kind", "rank", "piece"])

    pieces = sample.mapInArrow(segments, "kind int, rank binary, piece binary")
    of = lambda kind: pieces.filter(F.col("kind") == kind).orderBy("rank")
    listed = lambda rows: [bytes(r.piece) for r in rows.collect()]
    base = _trained(listed(of(2).limit(MOST_WINDOWS)), BASE_BYTES, b" ")
    # The documents are a bounded sample already; none of their segments goes.
    content = {"toxic": _trained(listed(of(1)), OWN_BYTES, base) + base,
               "ordinary": _trained(listed(of(0)), OWN_BYTES, base) + base}
    model = spark.sparkContext.broadcast(content)

    def measured(batches):
        ordinary, toxic = _compressor(model.value["ordinary"]), _compressor(model.value["toxic"])
        for batch in batches:
            x = [statistics(text, ordinary, toxic) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["toxic", "x"])

    rows = sample.mapInArrow(measured, "toxic int, x array<double>").collect()
    x = np.array([row.x for row in sorted(rows, key=lambda r: (r.toxic, r.x))])
    y = np.array(sorted(row.toxic for row in rows), float)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = _logistic((x - mean) / spread, y)
    # The sample holds more toxic documents than the training rows: back to their odds.
    weights[0] += math.log(share / (1 - share)) - math.log(n_toxic / n_ordinary)
    return {"share": share, "weights": weights, "mean": mean, "spread": spread, **content}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * w)
    return w


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every document."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        known = m["weights"] is not None
        ordinary, toxic = (_compressor(m["ordinary"]), _compressor(m["toxic"])) if known else (None, None)
        for batch in batches:
            scores = []
            for text in batch.column("text"):
                if known:
                    x = (np.array(statistics(text.as_py(), ordinary, toxic)) - m["mean"]) / m["spread"]
                    margin = float(m["weights"][0] + x @ m["weights"][1:])
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))))
                else:
                    scores.append(float(m["share"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
