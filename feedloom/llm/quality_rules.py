"""Quality rules with risk-controlled thresholds, native expressions only.

``word_statistics`` counts words, symbols, repeated lines and repeated three-word windows of whole
texts. ``select_cutoffs`` proposes cutoffs per stratum and rule from one half of the labelled documents
and certifies them on the other half: a cutoff is admissible if, were its true false-rejection rate
``risk / rules`` or more, so few rejected good documents would be seen with a probability of at most
``error / tests`` (exact binomial tail, Bonferroni over all tests of all strata). So with probability
1 - error, no stratum loses more than ``risk`` of its good documents to the method. Of the admissible
cutoffs of a rule the one with the largest gain (share of bad rejected less ``COST`` times that of good)
is taken, the mildest on ties; a stratum with too few labels gets none and keeps everything that passes
the base.

Null and empty texts have no words and fail the base. Null strata form a stratum of their own, ties
stay below a cutoff (only larger values are rejected), repeated rows are judged alike, and an empty
label table leaves the base alone. Extra columns are ignored. Windows are compared by 64-bit hashes
within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import SPACE_CHARS, let, stored, words

RISK, ERROR = 0.05, 0.05
COST = 20.0  # what losing a share of the good weighs against rejecting the same share of the bad
PROPOSED_GOOD = (0.95, 0.98, 0.99, 0.995, 0.999, 1.0)
PROPOSED_BAD = (0.1, 0.3, 0.5)
FEW = 64

# Rules: a statistic of a document, large where quality is low.
RULES: dict[str, str] = {
    "symbols": "try_divide(n_symbols, n_words)",
    "marks": "try_divide(n_marks, n_words)",
    "capitals": "try_divide(n_capitals, word_chars)",
    "repeated_words": "try_divide(n_repeat_words, n_words)",
    "repeated_lines": "try_divide(n_dup_lines, n_lines)",
    "long_words": "try_divide(word_chars, n_words)",
}


def _removed(text: Column, pattern: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def _repeated_starts(hashes: Column) -> Column:
    """Places whose hash occurs twice or more, ascending: for few such hashes by search in their list,
    otherwise by sorting hash and place together."""
    def few(repeats):
        return F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(repeats, h), i)),
                        lambda i: i.isNotNull())

    def many(ordered):
        return F.sort_array(F.transform(F.filter(ordered, lambda z, k: (
            F.get(ordered, k - 1)["h"].eqNullSafe(z["h"])) | F.get(ordered, k + 1)["h"].eqNullSafe(z["h"])),
            lambda z: z["i"]))

    repeats = let(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(s, lambda h, i: h == F.get(s, i - 1))))
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(repeats, lambda r: F.when(F.size(r) <= FEW, few(r)).otherwise(let(pairs, many)))


def word_statistics(docs: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    """``keep`` columns and the counts of every document."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    split = docs.select(*keep, text.alias("_text"), words(F.col(text_column)).alias("_words"))
    hashed = split.select(
        *keep, "_text", "_words",
        F.when(F.size("_words") < 3, F.array().cast("array<bigint>")).otherwise(F.slice(
            F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
            1, F.greatest(F.size("_words") - 2, F.lit(1)))).alias("_windows"),
        F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "").alias("_lines"))
    covered = let(F.col("_starts"), lambda starts: F.aggregate(
        F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3)))),
        F.lit(0), lambda total, n: total + n))
    starts = F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.array().cast("array<int>")) \
        .otherwise(_repeated_starts(F.col("_windows")))
    return hashed.withColumn("_starts", starts).select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _removed(F.col("_text"), r"[#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        _removed(F.col("_text"), r"[!?]+").alias("n_marks"),
        _removed(F.col("_text"), r"\p{Lu}+").alias("n_capitals")) \
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed in log space; 1 where k is beyond the mean."""
    first = n * F.log(F.lit(1 - p))
    step = lambda state, i: F.struct(
        (state["term"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))).alias("term"),
        (state["total"] + F.exp(state["term"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p))))).alias("total"))
    start = F.struct(first.alias("term"), F.exp(first).alias("total"))
    return F.when(k > n * p, F.lit(1.0)).when(k == 0, F.exp(first)) \
        .otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int")), start, step,
                               lambda state: state["total"]))


def select_cutoffs(statistics: DataFrame, labels: DataFrame, stratum: str, id_column: str = "doc_id",
                   risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, rule, cutoff, n, k, tail, caught, admissible, chosen): every tested cutoff.

    ``labels``: id and ``quality``, 1 for documents that must not be rejected.
    """
    truth = labels.filter("quality is not null").groupBy(id_column).agg(F.max("quality").alias("quality"))
    rows = statistics.filter(~F.col("base_failed")).join(truth, id_column).select(
        F.coalesce(F.col(stratum), F.lit("null")).alias("stratum"), "quality",
        (F.pmod(F.xxhash64(id_column, F.lit("halves")), F.lit(2)) == 1).alias("certify"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.expr(f"double({rule})").alias("x"))
                            for name, rule in RULES.items()])).alias("r"))
    rows = rows.select("stratum", "quality", "certify", "r.rule", "r.x").filter("x is not null")
    good, bad = F.when(F.col("quality") == 1, F.col("x")), F.when(F.col("quality") != 1, F.col("x"))
    proposed = rows.filter(~F.col("certify")).groupBy("stratum", "rule").agg(F.array_union(
        F.coalesce(F.percentile(good, F.array(*map(F.lit, PROPOSED_GOOD))), F.array().cast("array<double>")),
        F.coalesce(F.percentile(bad, F.array(*map(F.lit, PROPOSED_BAD))), F.array().cast("array<double>"))
    ).alias("cutoffs")).select("stratum", "rule", F.explode("cutoffs").alias("cutoff"))
    proposed = stored(statistics.sparkSession, proposed, "cutoffs")
    tests = max(1, proposed.count())
    share = risk / len(RULES)
    over = F.col("x") > F.col("cutoff")
    tested = rows.filter("certify").join(proposed, ["stratum", "rule"]).groupBy("stratum", "rule", "cutoff").agg(
        F.count(good).alias("n"), F.count_if(over & (F.col("quality") == 1)).alias("k"),
        F.count(bad).alias("n_bad"), F.count_if(over & (F.col("quality") != 1)).alias("caught"))
    judged = tested.withColumn("tail", binomial_tail(F.col("k"), F.col("n"), share)) \
        .withColumn("admissible", (F.col("n") > 0) & (F.col("tail") <= error / tests))
    gain = F.when(F.col("admissible") & (F.col("caught") > 0),
                  F.col("caught") / F.col("n_bad") - COST * F.col("k") / F.col("n"))
    best = judged.withColumn("gain", gain).filter("gain > 0").groupBy("stratum", "rule") \
        .agg(F.max(F.struct("gain", "cutoff"))["cutoff"].alias("best"))
    return judged.join(best, ["stratum", "rule"], "left") \
        .withColumn("chosen", F.coalesce(F.col("cutoff") == F.col("best"), F.lit(False))).drop("best")


def apply_rules(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, stratum: str = "lang",
                id_column: str = "doc_id", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Statistics of every document with ``base_failed``, the broken rules, and ``kept``."""
    spark = docs.sparkSession
    columns = list(dict.fromkeys([id_column, stratum, *(keep or [])]))
    statistics = stored(spark, word_statistics(docs, columns), "statistics")
    chosen = select_cutoffs(statistics, labels, stratum, id_column, risk, error).filter("chosen")
    cutoffs = stored(spark, chosen.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"_{name}") for name in RULES]), "chosen")
    broken = F.array_compact(F.array(*[F.when(F.expr(f"double({rule})") > F.col(f"_{name}"), F.lit(name))
                                       for name, rule in RULES.items()]))
    return statistics.withColumn("stratum", F.coalesce(F.col(stratum), F.lit("null"))) \
        .join(cutoffs, "stratum", "left").withColumn("broken_rules", broken) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)) \
        .select(*columns, *[c for c in statistics.columns if c not in columns], "broken_rules", "kept")
