"""Exact n-gram Jaccard join with signature trees, and the groups of linked documents.

1. Every text becomes the set of its distinct shingles (64-bit keys); equal sets form a class with a number
   of its own and a head, the row of the smallest id. From here on one row per class moves, copies are never
   compared.
2. Keys are ordered so that long, thus rare, shingles come first. Two sets of the wanted similarity
   share a key among the first ``|set| - ceil(t |set|) + 1`` of either, so classes meet in the bucket
   of such a key. A bucket carries sizes and signatures, not sets: a bitmap of all tokens, of a width
   that grows with the set. Sets of neighbouring widths whose sizes could fit also meet at the smaller
   width. Buckets beyond ``MOST_IN_BUCKET`` classes are dealt onto a grid of cells in which every pair
   meets.
3. In each bucket signature trees are traversed together (``signature_trees``); what could link gives
   candidate groups, usually a few documents.
4. The head texts of candidate classes are fetched by a key of id and text, once each, and the trees are traversed again with exact
   bitmaps over the tokens that two members share: these links are exact. Large candidate groups are
   dealt onto a grid as well. Groups of links are connected components in shuffles.

Lower-casing is A-Z only. Fewer words than a shingle: the whole sequence is one; no words or null: an
empty set, linked with nothing. Repeated rows and ids are returned as they are and fall into one class.
A null id takes no part in naming a group; different texts of one id are compared each. Extra columns are ignored. Very long texts are taken whole.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import components, python_ready, row_key, stored
from feedloom.llm.pieces import Pieces
from feedloom.llm.signature_trees import linked

MOST_IN_BUCKET = 20_000
MOST_TOKENS = 3_000_000
WIDTHS = [512 << k for k in range(9)]  # bits of a signature
FULL = 1.25  # tokens per bit up to which a width is used
MATRIX_BYTES = 1 << 25
_BATCH = 40_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@functools.lru_cache(maxsize=1)
def _word_hashes() -> Pieces:
    return Pieces(xxhash.xxh3_64_intdigest, 150_000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingle_keys(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct keys: four bits fall with the length of the shingle, sixty are its hash."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = _word_hashes()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    k = min(k, len(words))
    n = len(words) - k + 1
    total, length = np.full(n, np.uint64(k)), np.zeros(n, np.int64)
    for at in range(k):
        total = _mixed(total * _A + hashes[at:at + n])
        length += lengths[at:at + n]
    rank = np.clip(15 - (length - k) // 2, 0, 15).astype(np.uint64)
    return np.unique((rank << np.uint64(60)) | (total >> np.uint64(4)))


def _signatures(keys: np.ndarray, percent: int) -> list[tuple[int, bytes, int]]:
    """(width, bits, hidden tokens) of a set at its own width and, where a set of the next smaller width
    could be similar enough, at that width too."""
    n = len(keys)
    own = next((k for k, width in enumerate(WIDTHS) if n <= width * FULL), len(WIDTHS) - 1)
    places = (_mixed(keys * _A) >> np.uint64(40)).astype(np.int64)
    out = []
    for k in (own, own - 1):
        if k == own or (k >= 0 and n * percent <= 100 * WIDTHS[k] * FULL):
            bits = np.zeros(WIDTHS[k], np.uint8)
            bits[places % WIDTHS[k]] = 1
            out.append((WIDTHS[k], np.packbits(bits).tobytes(), n - int(bits.sum())))
    return out


def _sets(k: int, percent: int):
    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            digests, sizes, prefixes, signatures = [], [], [], []
            for text in batch.column("text"):
                keys = shingle_keys(text.as_py(), k)
                n = len(keys)
                digest = xxhash.xxh3_128_digest(keys.tobytes()) if n else None
                sizes.append(n)
                digests.append(digest)
                if n and digest not in seen:
                    seen.add(digest)
                    prefixes.append(keys[:n - -(-percent * n // 100) + 1].view(np.int64))
                    signatures.append([dict(zip(("width", "bits", "hidden"), s)) for s in _signatures(keys, percent)])
                else:
                    prefixes.append(None), signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(signatures, pa.list_(pa.struct(
                     [("width", pa.int32()), ("bits", pa.binary()), ("hidden", pa.int64())])))],
                names=["doc_id", "row", "digest", "n", "prefix", "signatures"])
    return run


def _runs(batches, columns: list[str]):
    """Rows of a task in batches that end where ``bucket`` changes; rows arrive sorted by bucket."""
    held: list[dict] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = {c: batch.column(c) for c in columns}
        bucket = part["bucket"].to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        last = held and held[-1]["bucket"][-1].as_py() != bucket[0]
        if size >= _BATCH and (last or len(ends)):
            cut = 0 if last else int(ends[0])
            if cut:
                held.append({c: a.slice(0, cut) for c, a in part.items()})
            yield {c: pa.concat_arrays([h[c] for h in held]) for c in columns}
            held, size = [], 0
            part = {c: a.slice(cut) for c, a in part.items()}
        held.append(part)
        size += len(part["bucket"])
    if held:
        yield {c: pa.concat_arrays([h[c] for h in held]) for c in columns}


def _edges(ids: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """Every set tied to the first one it is connected to."""
    tied = label != np.arange(len(label))
    return pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[label[tied]])], names=["a", "b"])


def _candidates(percent: int):
    columns = ["bucket", "class_id", "n", "width", "bits", "hidden"]

    def run(batches):
        for rows in _runs(batches, columns):
            number = {c: rows[c].to_numpy(zero_copy_only=False) for c in columns if c != "bits"}
            width = number["width"]
            cuts = [0, *(np.flatnonzero(width[1:] != width[:-1]) + 1).tolist(), len(width)]
            for low, high in zip(cuts, cuts[1:]):
                bits = np.frombuffer(b"".join(rows["bits"].slice(low, high - low).to_pylist()), np.uint64)
                label = linked(number["bucket"][low:high], number["n"][low:high],
                               bits.reshape(high - low, -1), number["hidden"][low:high], percent)
                yield _edges(number["class_id"][low:high], label)
    return run


def exact_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Labels of sets by exact overlaps: a bit for every token that two of the sets hold. Where these
    are too many bits they are folded, and what then may be a link is checked by intersection."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    at, owner = place[column[shared]], owner[shared]
    width = max(1, -(-int((count > 1).sum()) // 64))
    most = max(8, MATRIX_BYTES // (8 * len(sets)))
    folded = width > most
    width = min(width, most)
    at %= 64 * width
    bits = np.zeros((len(sets), width), np.uint64)
    np.bitwise_or.at(bits, (owner, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    size = np.array([len(s) for s in sets])
    hidden = np.bincount(owner, minlength=len(sets)) - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)

    def overlap_fits(i, j):
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)])
        return 100 * both >= percent * (size[i] + size[j] - both)

    return linked(np.zeros(len(sets), np.int64), size, bits, hidden, percent, overlap_fits if folded else None)


def _verified(k: int, percent: int):
    def group(ids, sets):
        order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), int(sets[i][0]), ids[i]))
        return _edges(np.array(ids, np.int64)[order], exact_links([sets[i] for i in order], percent))

    def run(batches):
        bucket, ids, sets = None, [], []
        for batch in batches:
            for key, number, text in zip(batch.column("bucket"), batch.column("class_id"), batch.column("text")):
                if key.as_py() != bucket:
                    if len(ids) > 1:
                        yield group(ids, sets)
                    bucket, ids, sets = key.as_py(), [], []
                ids.append(number.as_py())
                sets.append(shingle_keys(text.as_py(), k))
        if len(ids) > 1:
            yield group(ids, sets)
    return run


def _grid(rows: DataFrame, cells, *keys: str) -> DataFrame:
    """Rows of a group dealt onto ``cells`` x ``cells`` cells, each pair of rows meeting in one or more;
    ``bucket`` names group and cell."""
    own = F.pmod(F.xxhash64("class_id", F.lit("cell")), F.col("_cells"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_cells") - 1))
    return rows.withColumn("_cells", cells.cast("bigint")).withColumn("_own", own).withColumn("_other", other) \
        .withColumn("bucket", F.xxhash64(*keys, F.least("_own", "_other"), F.greatest("_own", "_other"))) \
        .drop("_cells", "_own", "_other")


def _grouped(docs: DataFrame, k: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, row, n, head) per row: ``row`` is its key, ``head`` (nameless, doc_id, row) the first row of
    its group, null for an empty set."""
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"),
                       row_key(id_column, text_column).alias("row"))
    sets = stored(spark, rows.mapInArrow(
        _sets(k, percent), "doc_id bigint, row binary, digest binary, n bigint, prefix array<bigint>, "
        "signatures array<struct<width: int, bits: binary, hidden: bigint>>"), "sets")
    first = [F.first(c, ignorenulls=True).alias(c) for c in ("n", "prefix", "signatures")]
    head = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    classes = sets.filter("digest is not null").groupBy("digest").agg(F.min(head).alias("head"), *first)
    named = stored(spark, classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")

    # Sizes fall into bands of the ratio that the similarity allows: partners are in one band or in
    # neighbouring ones. A bit per band (of 64 in a circle) tells which postings of a token have any.
    band = F.pmod(F.floor(F.log("n") / float(np.log(100 / percent))), F.lit(64)).cast("int")
    tokens = named.select("class_id", F.explode("prefix").alias("token"), band.alias("band"))
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)))
    met = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.bit_or(bit(F.col("band"))).alias("bands"))
    crowded = F.col("df") > F.bit_count("bands")
    turned = F.call_function("shiftleft", F.col("bands"), F.lit(1)).bitwiseOR(F.shiftrightunsigned("bands", 63))
    met = met.filter((F.col("df") > 1) & (crowded | (F.col("bands").bitwiseAND(turned) != 0)))
    beside = bit(F.col("band") - 1).bitwiseOR(bit(F.col("band") + 1)).bitwiseAND(F.col("bands")) != 0
    paired = tokens.join(met, "token").filter(crowded | beside)
    live = _grid(paired.select("class_id", "token", "df"), F.ceil(F.col("df") / MOST_IN_BUCKET), "token")
    signed = live.select("class_id", "bucket").join(
        named.select("class_id", "n", "signatures", F.get("prefix", F.lit(0)).alias("first")), "class_id") \
        .select("class_id", "bucket", "n", "first", F.explode("signatures").alias("s")) \
        .select("class_id", F.xxhash64("bucket", "s.width").alias("bucket"), "n", "first", "s.*")
    size_step = F.floor(F.log("n") / float(np.log(100 / percent)))
    sorted_rows = signed.repartition("bucket").sortWithinPartitions("width", "bucket", size_step, "first", "class_id")
    candidates = sorted_rows.select("bucket", "class_id", "n", "width", "bits", "hidden") \
        .mapInArrow(_candidates(percent), "a bigint, b bigint")
    groups = components(spark, candidates)

    sizes = named.select("class_id", "n").join(groups.withColumnRenamed("node", "class_id"), "class_id")
    sizes = stored(spark, sizes, "candidates")
    totals = sizes.groupBy("component").agg(F.sum("n").alias("tokens"))
    placed = _grid(sizes.join(totals, "component"), F.ceil(F.col("tokens") / MOST_TOKENS), "component")
    heads = named.select("class_id", F.col("head.row").alias("row"))
    texts = rows.select("row", "text").join(sizes.select("class_id").join(heads, "class_id"), "row") \
        .groupBy("class_id").agg(F.max("text").alias("text"))
    checked = texts.join(placed.select("class_id", "bucket"), "class_id").repartition("bucket") \
        .sortWithinPartitions("bucket", "class_id").select("bucket", "class_id", "text") \
        .mapInArrow(_verified(k, percent), "a bigint, b bigint")
    found = components(spark, checked).select(F.col("node").alias("class_id"), F.col("component"))

    tied = stored(spark, found.join(named.select("class_id", "digest", "head"), "class_id"), "tied")
    best = tied.groupBy("component").agg(F.min("head").alias("best"))
    best = tied.join(best, "component").select("digest", "best")
    ends = named.select("digest", "head").join(best, "digest", "left") \
        .select("digest", F.coalesce("best", "head").alias("head"))
    return sets.select("doc_id", "row", "digest", "n").join(ends, "digest", "left").drop("digest")


def jaccard_groups(docs: DataFrame, k: int = 3, percent: int = 90, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) per document: the smallest id that links lead to.

    Links: ``100 * intersection >= percent * union`` of the sets of ``k``-word shingles.
    """
    return _grouped(docs, k, percent, id_column, text_column).select(
        F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"),
        F.coalesce("head.doc_id", "doc_id").alias("component_id"))


def first_rows(docs: DataFrame, k: int, percent: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row), the ``row_key`` of the first row of every group; rows without shingles are their own group."""
    return _grouped(docs, k, percent, id_column, text_column) \
        .filter("head is null or row = head.row").select("row")
