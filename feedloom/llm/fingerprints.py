"""Document fingerprints by one-permutation MinHash, native expressions only.

The 64-bit hashes of a text's five-word shingles (the whole sequence where there are fewer words) are
dealt into ``BINS`` bins by their high bits, once; the smallest hash of a bin is its value. An empty bin
borrows: it probes other bins in a fixed order of its own until one is filled, so two texts with the
same filled bins borrow alike (optimal densification). The low ``BITS`` bits per bin are kept as two hex
digits. ``likeness`` estimates the Jaccard similarity of two texts from the share of equal bins, less
the share that agrees by chance.

Null and empty texts have the fingerprint of all zeros: likeness 1 to each other, about 0 to others.
Equal texts have equal fingerprints. Texts of any length are hashed whole. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import let, stored, words

SHINGLE = 5
BIN_BITS, BITS = 7, 8
BINS = 1 << BIN_BITS
PROBES = 12
_LOW = (1 << (64 - BIN_BITS)) - 1
_HEX = [f"{k:02x}" for k in range(1 << BITS)]


def _shingle_hashes(text: Column) -> Column:
    def hashed(w):
        rolled = F.transform(w, lambda word, i: F.xxhash64(word, *[F.get(w, i + k) for k in range(1, SHINGLE)]))
        return F.when(F.size(w) >= SHINGLE, F.slice(rolled, 1, F.greatest(F.size(w) - SHINGLE + 1, F.lit(1)))) \
            .when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return let(words(text), hashed)


def _bins(hashes: Column) -> Column:
    """The smallest hash per bin, null in empty bins: bins are runs of the sorted hashes, and a last
    possible value per bin makes sure that each has a run."""
    ends = F.array(*[F.lit((k << (64 - BIN_BITS)) | _LOW) for k in range(-BINS // 2, BINS // 2)])
    of_bin = lambda x: F.shiftright(x, 64 - BIN_BITS)
    firsts = let(F.sort_array(F.concat(hashes, ends)),
                 lambda s: F.filter(s, lambda x, i: ~of_bin(x).eqNullSafe(of_bin(F.get(s, i - 1)))))
    return F.transform(firsts, lambda x: F.when(x.bitwiseAND(F.lit(_LOW)) != _LOW, x))


def _densified(bins: Column) -> Column:
    def dense(b):
        filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(b, j).isNotNull())

        def borrow(f):
            def value(x, i):
                probes = [F.get(b, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
                nearest = F.array_min(F.transform(f, lambda j: F.struct(F.xxhash64(i, j).alias("h"), F.get(b, j).alias("v"))))
                return F.coalesce(x, *probes, nearest["v"])
            return F.transform(b, value)
        return F.when(F.exists(b, lambda x: x.isNull()), let(filled, borrow)).otherwise(b)
    return let(bins, dense)


def fingerprint(text: Column) -> Column:
    """Hex string of ``BINS * BITS`` bits."""
    hashes = _shingle_hashes(text)
    table = F.array(*map(F.lit, _HEX))
    packed = F.array_join(F.transform(_densified(_bins(hashes)), lambda x: F.get(
        table, x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))), "")
    blank = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == ""
    return F.when(blank, F.lit("0" * (2 * BINS))).otherwise(packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts of two fingerprints, 0 to 1."""
    equal = F.size(F.filter(F.sequence(F.lit(1), F.lit(2 * BINS - 1), F.lit(2)),
                            lambda i: F.substring(a, i, F.lit(2)) == F.substring(b, i, F.lit(2)))) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance)))


def with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_bucket: int = 1024) -> DataFrame:
    """(id, text, bucket, last_in_bucket, next_text): each document with the following one in descending
    id order, the last with the first. Nulls come last; equal ids are ordered by text.

    Ids are cut into ranges of about ``per_bucket`` rows by a histogram, texts move once, and the first
    text of each range is all that neighbouring ranges exchange.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    low, high, n = rows.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    cells = max(1, min(1 << 20, n // 128))
    span = float((high or 0) - (low or 0) + 1)
    cell = F.coalesce(F.floor((F.col("id") - F.lit(low or 0)) / F.lit(span) * cells), F.lit(-1))
    descending = Window.orderBy(F.desc("cell"))
    ranges = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("head")) \
        .withColumn("before", F.coalesce(F.sum("n").over(descending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .select("cell", "head", F.floor(F.col("before") / per_bucket).alias("bucket"))
    ranges = stored(spark, ranges, "ranges")
    placed = rows.withColumn("cell", cell).join(ranges.select("cell", "bucket"), "cell").drop("cell")

    heads = ranges.groupBy("bucket").agg(F.max("head").alias("head"))
    after = Window.orderBy("bucket")
    first = F.first("bucket").over(after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = heads.select("bucket", F.coalesce(F.lead("bucket").over(after), first).alias("next_bucket"))
    texts = placed.join(heads.withColumnRenamed("bucket", "_b"), F.col("id").eqNullSafe(F.col("head")) & (
        F.col("bucket") == F.col("_b"))).groupBy("bucket").agg(F.max("text").alias("head_text"))
    texts = stored(spark, following.join(texts.withColumnRenamed("bucket", "next_bucket"), "next_bucket")
                   .select("bucket", "head_text"), "heads")

    order = Window.partitionBy("bucket").orderBy(F.col("id").desc_nulls_last(), F.desc("text"))
    led = placed.withColumn("next_text", F.lead("text").over(order))
    return led.join(texts.hint("shuffle_hash"), "bucket").select(
        "id", "text", "bucket", F.col("next_text").isNull().alias("last_in_bucket"),
        F.coalesce("next_text", "head_text").alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """``text`` whose last third is replaced by as many of the first code points of ``following``."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and likenesses to the latter and to the
    next document (descending ids)."""
    rows = with_next(docs, id_column, text_column)
    own = rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))).select(
        "id", "bucket", "text", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"),
        F.when(F.col("last_in_bucket"), fingerprint(F.col("next_text"))).alias("_head"))
    order = Window.partitionBy("bucket").orderBy(F.col("id").desc_nulls_last(), F.desc("text"))
    led = own.withColumn("_next", F.coalesce(F.col("_head"), F.lead("fingerprint").over(order)))
    return led.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))
