"""Registered queries of the subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import bpe, pii, quality_model, toxicity
from feedloom.llm.common import table
from feedloom.llm.conversation_repair import repair
from feedloom.llm.fill_in_middle import fill_in_middle, restore
from feedloom.llm.fingerprints import fingerprints
from feedloom.llm.jaccard import jaccard_groups
from feedloom.llm.license_scan import scan_licenses
from feedloom.llm.mixing import mix_plan
from feedloom.llm.quality_rules import apply_rules
from feedloom.llm.token_counts import token_counts
from feedloom.llm.wrappers import extract_text
from feedloom.session import scratch_folder

BYTE_BPE = "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                        scratch_folder(spark, "token-count-cache"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")) \
        .withColumn("n_chars", F.char_length("text").cast("long"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)
    coded = bpe.encode(docs, path, bpe.build_lexicon(docs, path))
    return bpe.decode(coded, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~_held_out())
    return toxicity.score(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.fit(docs)) \
        .withColumn("kept", F.col("score") >= quality_model.CUTOFF)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_licenses(table(spark, sf_dir, "documents"))
    both = F.concat(*[F.transform(c, lambda m: F.struct(m["label"].alias("label"), m["containment"].alias("containment")))
                      for c in ("matches", "wrapped")])
    rows = rows.withColumn("found", both)
    found = F.transform("found", lambda m: m["label"])
    return rows.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.array_join("phrase_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("phrase_labels", found)), ",").alias("labels"),
        F.greatest(F.when(F.size("starts") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(
            F.transform("found", lambda m: m["containment"])), F.lit(0.0))).alias("score"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.fit(docs))
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base").cast("binary"), 256).alias("base_sha256"),
                        pii.joined(F.concat("base", "added")).alias("spans"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore("output", "form").cast("binary"), 256).alias("restored_sha256"))


def llm_queries() -> dict:
    return {f.__name__: f for f in (
        op1_token_counts, op2_html_text, op3_quality_rules, op4_bpe_codec, op5_toxicity, op6_quality_classifier,
        op7_source_mix, op8_license_scan, op9_fingerprints, op10_ngram_jaccard, op11_conversation_repair, op12_pii,
        op13_fill_in_middle)}


# DuckDB: cuts of op13 from the list of units, without a skip list.
FILL_IN_MIDDLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS toks,
         ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
         ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4 FROM d),
c AS (
  SELECT *, len(toks) AS n,
         CASE WHEN t = '' OR strpos(t, '<P>') > 0 OR strpos(t, '<S>') > 0 OR strpos(t, '<M>') > 0
              OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS a,
         greatest(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS b FROM u),
p AS (
  SELECT *, array_to_string(list_slice(toks, 1, a), '') AS pre, array_to_string(list_slice(toks, a + 1, b), '') AS mid,
         array_to_string(list_slice(toks, b + 1, n), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def llm_oracles() -> dict[str, str]:
    return {"op13_fill_in_middle": FILL_IN_MIDDLE_SQL}
