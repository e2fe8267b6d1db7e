"""Token counts behind a digest cache.

Content is normalised to the form the tokenizer sees (null becomes the empty text; a tokenizer with a
normalizer of its own can be given another ``normal`` expression), digested together with the digest
of the vocabulary file, and joined to a stored table of counts. Only distinct texts without a stored
count are encoded; their counts are appended to the table.

Nulls and empty texts have 0 tokens. Repeated texts share one cache row; repeated rows are all
returned. Very long texts are encoded in pieces (see ``pieces``), with the count of the whole text.
Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready, stored
from feedloom.llm.pieces import PieceEncoder

CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> PieceEncoder:
    """Per worker: counts of pieces by the tokenizer's own library, .json or .model."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return PieceEncoder(lambda piece: len(tokenizer.encode(piece, add_special_tokens=False)) if piece else 0)


def _counts_of(path: str):
    """A function from a text to its number of tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text, num_threads=1))
    import json

    with open(path, encoding="utf-8") as file:
        layout = json.load(file)
    cuttable = layout["normalizer"] is None and (layout["pre_tokenizer"] or {}).get("type") == "ByteLevel" \
        and not layout["pre_tokenizer"].get("add_prefix_space")
    if cuttable:
        counter = _counter(path)
        return lambda text: sum(counter.each(text))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False))


def _once_per_task(batches):
    """Drops repeats of a digest within a task, so that copies of a hot text meet as a few rows."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for digest in batch.column("digest").to_pylist():
            keep.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(keep))


def _encoder(path: str):
    def encode(batches):
        seen: set[bytes] = set()
        count = _counts_of(path)
        for batch in batches:
            digests, counts = [], []
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text")):
                if digest not in seen:
                    seen.add(digest)
                    digests.append(digest)
                    counts.append(count(text.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64())],
                                             names=["digest", "n_tokens"])
    return encode


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer version, one row per digest; empty when there is no cache yet."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = 512, normal=None) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit, content digest.

    ``tokenizer``: vocabulary file, present on every machine. ``cache``: folder of the stored counts,
    reachable from every machine; misses are appended to it before the result is returned.
    """
    spark = docs.sparkSession
    python_ready(spark)
    version = tokenizer_version(tokenizer)
    text = F.coalesce((normal or (lambda column: column))(F.col(text_column)), F.lit(""))
    keyed = docs.select(F.col(id_column), text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))

    # Texts move once: the join with the cache keeps the partitioning by digest.
    texts = keyed.select("digest", "text").mapInArrow(_once_per_task, "digest binary, text string") \
        .repartition("digest")
    known = stored_counts(spark, cache, version).select("digest").hint("shuffle_hash")
    misses = texts.join(known, "digest", "left_anti").select("digest", "text")
    misses.mapInArrow(_encoder(tokenizer), "digest binary, n_tokens long") \
        .select("digest", F.lit(version).alias("version"), "n_tokens") \
        .write.mode("append").parquet(cache)

    # The counts are stored first, so that both sides of the join are plain exchanges and the rows of
    # a digest that many documents share can be split.
    counts = stored(spark, stored_counts(spark, cache, version), "counts")
    slim = keyed.select(id_column, F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return slim.join(counts, "digest", "left").select(
        id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        F.lower(F.hex("digest")).alias("content_sha256"))
