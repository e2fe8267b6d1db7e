"""The corpus pipeline: five stages over ``documents``, each on all that its predecessor kept.

1. ``quality_classifier``: documents that the weakly supervised scorer rejects go.
2. ``quality_rules``: documents that fail the base or a certified cutoff of their language go.
3. ``ngram_jaccard``: of each group of near copies (five-word shingles, similarity 0.8 or more) the
   document with the smallest id stays, without ids one of them; equal ids with equal texts become one row.
4. ``source_mix``: every document as often as the mix takes it, shard by shard in shuffled order.
5. ``bpe_encode``: token ids of every row.

A null text is an empty one: it has no words and is rejected by the first stage. Stages find rows again by
a key of id and text (``row_key``), so rows without an id and different texts of one id are judged and
mixed one by one. Null sources and languages are values of their own. Extra columns
pass through all stages but the last. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import bpe, quality_model
from feedloom.llm.common import row_key, stored, table
from feedloom.llm.jaccard import first_rows
from feedloom.llm.mixing import mix_plan, mixed
from feedloom.llm.quality_rules import apply_rules

SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
KEY = "_row_key"
VOCABULARY = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep(docs, quality_model.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.withColumn(KEY, row_key("doc_id"))
    judged = apply_rules(keyed, table(spark, sf_dir, "labels"), keep=[KEY])
    return keyed.join(judged.filter("kept").select(KEY), KEY, "left_semi").select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.withColumn(KEY, row_key("doc_id"))
    kept = first_rows(docs, SHINGLE_WORDS, SIMILARITY_PERCENT).withColumnRenamed("row", KEY)
    return keyed.join(kept, KEY, "left_semi").dropDuplicates([KEY]).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(mix_plan(docs, ["doc_id"]), docs).select(*docs.columns)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode(docs, path, bpe.build_lexicon(docs, path), keep=["lang", "source"])


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mix", source_mix),
    ("bpe_encode", bpe_encode),
]

# Trained scorers, hash permutations and BPE are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return docs
