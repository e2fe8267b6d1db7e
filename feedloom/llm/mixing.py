"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, native only.

1. Sources get targets: weights share all words, no target exceeds ``MOST_PASSES`` times its source, the
   excess goes to the others by weight.
2. The documents of a source are dealt into blocks of about ``block_words`` words by a hash of the kept
   columns and the text, which permutes them. A target of 2.3 sources takes every block twice and, in block order, blocks for the
   rest; the block at the end of the rest gives documents, largest first, as they still fit, and one
   more if that comes closer.
3. The blocks each source gives are exact quotas. From the root, which holds all output shards, every
   node hands its left half a draw without replacement from its quotas (a multivariate hypergeometric
   draw, source after source), until each shard has exact quotas per source that add up to the whole.
4. A source's block draws are numbered; each shard takes the next range of them, so draws are disjoint.
   ``mixed`` lists a shard's documents and shuffles them within the shard.

All draws come from hashes of ``seed``: reruns agree. Null and empty texts have size 0 and take no
words. A null source is a source, ordered last. Repeated rows count one by one. A source without words
has target 0. An empty table has an empty mix. Extra columns are ignored unless kept. The number of
sources must fit in one row (each tree node holds one count per source); all else may grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import let, row_key, stored, words

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_WORDS = 65_536
BLOCKS_PER_SHARD = 256
RUN = 4096


def source_targets(sized: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, target) of a table with ``source`` and ``size``."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*map(F.lit, weights))
    ranked = sums.withColumn("weight", F.get(kinds, (F.row_number().over(order) - 1) % len(weights)).cast("double")) \
        .withColumn("cap", F.col("source_size") * F.lit(float(MOST_PASSES)))
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    # The sources that hit their cap come first in this order; the level is the share per unit of weight.
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    capped = ranked.withColumn("capped", F.col("cap") < level * F.col("weight"))
    rest = F.sum("source_size").over(everything) - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    free = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    return capped.select("source", "source_size", F.when(F.col("capped"), F.col("cap"))
                         .otherwise(F.least(F.col("cap"), F.try_divide(rest, free) * F.col("weight"))).alias("target"))


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series from 20 on."""
    small, total = [0.0], 0.0
    import math
    for k in range(1, 20):
        total += math.log(k)
        small.append(total)
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n < 20, F.get(F.array(*map(F.lit, small)), n.cast("int"))).otherwise(series)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """Marked items among ``drawn`` of ``total`` items of which ``marked`` are marked, by inverting the
    distribution at ``uniform``; it is walked over all but a share below 1e-30 of its mass."""
    def walk(p):
        low = F.greatest(F.lit(0).cast("bigint"), p["n"] - (p["r"] - p["k"]))
        high = F.least(p["n"], p["k"])
        mean = p["n"].cast("double") * p["k"] / p["r"]
        reach = 12 * F.sqrt(mean * (1 - p["k"] / p["r"])) + 12
        first = F.greatest(low, F.floor(mean - reach))
        last = F.least(high, F.ceil(mean + reach))
        chance = F.exp(_log_choose(p["k"], first) + _log_choose(p["r"] - p["k"], p["n"] - first)
                       - _log_choose(p["r"], p["n"]))
        start = F.struct(first.alias("x"), chance.alias("p"), chance.alias("c"))

        def step(s, i):
            grown = s["p"] * (p["k"] - i) * (p["n"] - i) / ((i + 1) * (p["r"] - p["k"] - p["n"] + i + 1))
            return F.when(s["c"] >= p["u"], s).otherwise(F.struct(
                (i + 1).alias("x"), grown.alias("p"), (s["c"] + grown).alias("c")))

        return F.when(first >= last, first).otherwise(
            F.aggregate(F.sequence(first, F.greatest(first, last - 1)), start, step, lambda s: s["x"]))

    packed = F.struct(total.cast("bigint").alias("r"), marked.cast("bigint").alias("k"),
                      drawn.cast("bigint").alias("n"), uniform.alias("u"))
    return F.when((drawn <= 0) | (marked <= 0), F.lit(0).cast("bigint")).when(drawn >= total, marked.cast("bigint")) \
        .otherwise(let(packed, walk))


def _uniform(*keys: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*keys), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, source number, draws) for the one-row table ``quotas`` (counts: array of draws per source).

    The shards' totals differ by one at most. Each level splits every node in place; from the sixth on
    the nodes are spread over tasks.
    """
    nodes = quotas.select(F.lit(0).cast("bigint").alias("low"), F.lit(shards).cast("bigint").alias("high"),
                          "counts", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"),
                          F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("all"))
    width, level = 1, 0
    while width < shards:
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        edge = lambda at: F.floor(F.col("all") * at / shards)
        nodes = nodes.withColumn("middle", middle).withColumn("left", F.when(
            F.col("high") - F.col("low") < 2, F.lit(0).cast("bigint")).otherwise(edge(middle) - edge(F.col("low"))))
        start = F.struct(F.col("total").alias("r"), F.col("left").alias("n"),
                         F.array().cast("array<bigint>").alias("out"))

        def step(state, item):
            x = hypergeometric(state["r"], item["k"], state["n"],
                               _uniform(F.lit(seed), F.col("low"), F.col("high"), item["i"]))
            return let(x, lambda x: F.struct((state["r"] - item["k"]).alias("r"), (state["n"] - x).alias("n"),
                                             F.array_append(state["out"], x).alias("out")))

        items = F.transform("counts", lambda k, i: F.struct(k.alias("k"), i.alias("i")))
        nodes = nodes.withColumn("drawn", F.aggregate(items, start, step, lambda s: s["out"]))
        right = F.zip_with("counts", "drawn", lambda a, b: a - b)
        children = F.when(F.col("high") - F.col("low") < 2, F.array(F.struct(
            F.col("low"), F.col("high"), F.col("counts"), F.col("total")))).otherwise(F.array(
                F.struct(F.col("low"), F.col("middle").alias("high"), F.col("drawn").alias("counts"),
                         F.col("left").alias("total")),
                F.struct(F.col("middle").alias("low"), F.col("high"), right.alias("counts"),
                         (F.col("total") - F.col("left")).alias("total"))))
        nodes = nodes.select(F.explode(children).alias("c"), "all").select("c.*", "all")
        nodes = stored(quotas.sparkSession, nodes.repartition(8) if level == 5 else nodes, "split", slim=True)
        width, level = width * 2, level + 1
    return nodes.select(F.col("low").alias("shard"), F.posexplode("counts").alias("number", "draws"))


def mix_plan(docs: DataFrame, keep: list[str], seed: int = 1, block_words: int = BLOCK_WORDS, weights=WEIGHTS,
             source_column: str = "source", text_column: str = "text") -> DataFrame:
    """``keep`` columns (the id first), source, size, source_size, target, ``shards``: one entry per copy in
    the mix, and ``mix_row``, the key of id and text by which ``mixed`` finds the row again."""
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), *keep, F.coalesce(F.col(text_column), F.lit("")))
    sized = stored(spark, docs.select(*keep, row_key(keep[0], text_column).alias("mix_row"), F.col(source_column).alias("source"), key.alias("_key"),
                                      F.size(words(F.col(text_column))).cast("long").alias("size")), "sizes", slim=True)
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(F.try_divide("target", "source_size"))).otherwise(0).cast("int")
    numbered = source_targets(sized, weights).withColumn("blocks", n_blocks).withColumn("full", full) \
        .withColumn("rest", F.round(F.col("target") - F.col("full") * F.col("source_size")).cast("long")) \
        .withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    sources = stored(spark, numbered.coalesce(1), "sources", slim=True)  # fits in one row, see above
    rows = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"]) \
        .withColumn("block", F.pmod("_key", "blocks"))

    # Words before each block of a source: sums of runs of blocks first, then within a run.
    sums = rows.groupBy("number", "block", "blocks", "full", "rest").agg(F.sum("size").alias("in_block")) \
        .withColumn("run", F.floor(F.col("block") / RUN))
    runs = Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before_run = sums.groupBy("number", "run").agg(F.sum("in_block").alias("in_run")) \
        .withColumn("before_run", F.coalesce(F.sum("in_run").over(runs), F.lit(0)))
    within = Window.partitionBy("number", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("within", F.coalesce(F.sum("in_block").over(within), F.lit(0))) \
        .join(before_run, ["number", "run"]).withColumn("before", F.col("within") + F.col("before_run"))
    placed = placed.select("number", "block", "blocks", "full", (F.col("before") < F.col("rest")).alias("started"), (
        F.col("rest") - F.col("before")).alias("room"), "in_block")
    placed = stored(spark, placed, "placed", slim=True)

    # Numbered draws: pass after pass; a pass begins at another block. Empty blocks are drawn as well.
    passes = F.sequence(F.lit(0), F.col("full") + F.col("started").cast("int") - 1)
    draws = placed.filter((F.col("full") > 0) | F.col("started")).select(
        "number", "block", "full", "blocks", F.explode(passes).alias("pass")) \
        .withColumn("draw", F.col("pass") * F.col("blocks") + F.when(F.col("pass") < F.col("full"), F.pmod(
            F.col("block") + F.pmod(F.xxhash64(F.lit(seed), "number", "pass"), "blocks"), "blocks"))
            .otherwise(F.col("block")))
    runs_of_draws = draws.groupBy("number", F.floor(F.col("draw") / RUN).alias("run")).agg(F.count(F.lit(1)).alias("n"))
    runs_of_draws = runs_of_draws.withColumn("first", F.coalesce(F.sum("n").over(runs), F.lit(0)))
    ranks = Window.partitionBy("number", "run").orderBy("draw")
    draws = draws.withColumn("run", F.floor(F.col("draw") / RUN)).join(runs_of_draws, ["number", "run"]) \
        .withColumn("place", F.col("first") + F.row_number().over(ranks) - 1) \
        .select("number", "block", "place", (F.col("pass") < F.col("full")).alias("whole"))
    draws = stored(spark, draws, "draws", slim=True)
    counts = draws.groupBy("number").agg(F.count(F.lit(1)).alias("n"))
    counts = sources.select("number").join(counts, "number", "left")
    quotas = counts.agg(F.sort_array(F.collect_list(F.struct("number", F.coalesce("n", F.lit(0)).alias("n")))).alias("q")) \
        .select(F.transform("q", lambda q: q["n"]).alias("counts"))
    shards = max(1, -(-draws.count() // BLOCKS_PER_SHARD))
    split = split_quotas(quotas, shards, seed)
    ranges = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = split.withColumn("first", F.coalesce(F.sum("draws").over(ranges), F.lit(0))).filter("draws > 0") \
        .select("number", "shard", F.explode(F.sequence("first", F.col("first") + F.col("draws") - 1)).alias("place"))
    homes = draws.join(dealt, ["number", "place"]).groupBy("number", "block").agg(
        F.sort_array(F.collect_list(F.when(F.col("whole"), F.col("shard")))).alias("whole_in"),
        F.max(F.when(~F.col("whole"), F.col("shard"))).alias("rest_in"))
    homes = placed.select("number", "block", "room", "in_block").join(homes, ["number", "block"])

    mixed = rows.join(homes, ["number", "block"], "left")
    ending = F.col("rest_in").isNotNull() & (F.col("room") < F.col("in_block"))
    outside = mixed.filter(~F.coalesce(ending, F.lit(False))).withColumn("shards", F.coalesce(F.when(
        F.col("rest_in").isNull(), F.col("whole_in")).otherwise(F.array_append("whole_in", F.col("rest_in"))),
        F.array().cast("array<bigint>")))
    # One block per source at most ends within its words: a bounded list, largest document first.
    columns = [*keep, "mix_row", "source", "size", "source_size", "target"]
    listed = mixed.filter(ending).groupBy("number", "block", "room").agg(F.first("whole_in").alias("whole_in"), F.first(
        "rest_in").alias("rest_in"), F.sort_array(F.collect_list(F.struct(
            (-F.col("size")).alias("_order"), "_key", *columns))).alias("list"))
    fitted = F.aggregate("list", F.struct(F.col("room").alias("room"), F.array().cast("array<boolean>").alias("taken")),
                         lambda s, d: F.struct(
                             F.when(d["size"] <= s["room"], s["room"] - d["size"]).otherwise(s["room"]).alias("room"),
                             F.array_append(s["taken"], d["size"] <= s["room"]).alias("taken")))

    def nearest(state):
        """One more document, the smallest left, where that comes closer."""
        last = F.size(state["taken"]) - F.array_position(F.reverse(state["taken"]), False)
        smallest = F.get("list", last.cast("int"))["size"]
        closer = (F.array_position(state["taken"], False) > 0) & (smallest < 2 * state["room"])
        return F.transform(state["taken"], lambda t, i: t | ((i == last) & F.coalesce(closer, F.lit(False))))

    fitted = let(fitted, nearest)
    at_end = listed.withColumn("taken", fitted).select(
        "whole_in", "rest_in", F.explode(F.arrays_zip("list", "taken")).alias("z")) \
        .select("z.list.*", F.when(F.col("z.taken"), F.array_append("whole_in", F.col("rest_in")))
                .otherwise(F.col("whole_in")).alias("shards"))
    return outside.select(*columns, "shards").unionByName(at_end.select(*columns, "shards"))


def mixed(plan: DataFrame, docs: DataFrame, id_column: str = "doc_id", seed: int = 1,
          text_column: str = "text") -> DataFrame:
    """The mix itself: the columns of ``docs`` and ``mix_shard``, one row per copy, shuffled in each shard.

    Rows of one id and one text count as one document with the copies of all of them; different texts of an
    id, and texts without an id, are documents of their own. Columns of ``docs`` that are called
    ``mix_shard`` or ``mix_row`` are replaced.
    """
    copies = plan.select("mix_row", F.explode("shards").alias("mix_shard"))
    single = docs.drop("mix_shard", "mix_row").withColumn("mix_row", row_key(id_column, text_column)) \
        .dropDuplicates(["mix_row"])
    return single.join(copies, "mix_row").repartition("mix_shard").sortWithinPartitions(
        "mix_shard", F.xxhash64(F.lit(seed), id_column, "mix_shard"), id_column, "mix_row").drop("mix_row")
