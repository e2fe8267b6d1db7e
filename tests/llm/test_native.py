"""Quality rules, mixing and fingerprints against brute force, and on odd tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
from pyspark.sql import functions as F

from feedloom.llm import fingerprints as fp
from feedloom.llm import mixing, quality_rules


def base_of(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def labels(spark, rows=()):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_base_statistics(spark, sf_dir, docs, rows):
    got = {r.doc_id: base_of(r) for r in quality_rules.apply_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert got == {r.doc_id: brute.base_statistics(r.text) for r in rows}


def test_odd_statistics(spark, odd, none):
    got = quality_rules.apply_rules(odd, labels(spark)).collect()
    texts = odd.select("doc_id", "text").collect()
    assert Counter((r.doc_id, base_of(r)) for r in got) == Counter((r.doc_id, brute.base_statistics(r.text)) for r in texts)
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality_rules.apply_rules(none, labels(spark)).collect() == []


def test_many_repeats_use_the_sorted_form(spark):
    text = " ".join(f"w{k % 500}" for k in range(1_700))
    row = quality_rules.word_statistics(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first()
    assert base_of(row) == brute.base_statistics(text)


def test_binomial_tail(spark):
    cases = [(0, 50, 0.1), (3, 50, 0.1), (5, 50, 0.1), (7, 200, 0.05), (120, 5_000, 0.05)]
    for k, n, p in cases:
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) if n < 1_000 else math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
            for i in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k), F.lit(n), p).alias("x")).first().x
        assert math.isclose(got, exact, rel_tol=1e-9)


def test_cutoffs_are_certified(spark):
    rng = np.random.default_rng(3)
    clean = [" ".join(f"w{rng.integers(9999)}" for _ in range(60)) for _ in range(3_000)]
    junk = [" ".join(f"w{rng.integers(9999)}$$$" for _ in range(60)) for _ in range(400)]
    table = spark.createDataFrame([(k, t, "en") for k, t in enumerate(clean + junk)], "doc_id long, text string, lang string")
    known = labels(spark, [(k, int(k < 3_000), 0) for k in range(3_400)])
    got = quality_rules.apply_rules(table, known).collect()
    assert sum(not r.kept for r in got if r.doc_id < 3_000) <= 0.05 * 3_000
    assert all(not r.kept for r in got if r.doc_id >= 3_000)
    few = quality_rules.apply_rules(table.filter("doc_id % 50 = 0"), known)
    assert few.filter("not kept and not base_failed").count() == 0


def words_of(text):
    return len(brute.WORD.findall(text or ""))


def check_mix(rows, plan):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words_of(r.text)
    goal, taken = brute.targets(dict(sizes)), defaultdict(int)
    assert len(plan) == len(rows)
    for p in plan:
        assert p.source_size == sizes[p.source] and math.isclose(p.target, goal[p.source], rel_tol=1e-9, abs_tol=1e-6)
        assert len(p.shards) <= 3
        taken[p.source] += p.size * len(p.shards)
    return {s: (goal[s], taken[s]) for s in goal}


def test_mix_meets_targets(docs, rows):
    plan = mixing.mix_plan(docs, ["doc_id"]).collect()
    for goal, taken in check_mix(rows, plan).values():
        assert abs(goal - taken) <= max(12, 0.06 * goal)
    again = mixing.mix_plan(docs, ["doc_id"]).collect()
    assert sorted((p.doc_id, p.shards) for p in plan) == sorted((p.doc_id, p.shards) for p in again)


def test_mix_small_blocks_and_odd_rows(odd, none, docs, rows):
    plan = mixing.mix_plan(docs, ["doc_id"], block_words=300)
    largest = max(words_of(r.text) for r in rows)
    assert all(abs(g - t) <= largest for g, t in check_mix(rows, plan.collect()).values())
    out = mixing.mixed(plan, docs)
    assert out.count() == sum(len(p.shards) for p in plan.collect())
    odd_plan = mixing.mix_plan(odd, ["doc_id"])
    check_mix(odd.collect(), odd_plan.collect())
    assert set(mixing.mixed(odd_plan, odd).columns) == set(odd.columns)
    assert mixing.mix_plan(none, ["doc_id"]).collect() == []


def test_splitting_tree_keeps_quotas_and_spreads(spark):
    quotas = spark.createDataFrame([([1000, 300, 0, 37],)], "counts array<bigint>")
    got = mixing.split_quotas(quotas, 13, seed=5).collect()
    totals, shards = Counter(), Counter()
    for r in got:
        totals[r.number] += r.draws
        shards[r.shard] += r.draws
    assert [totals[k] for k in range(4)] == [1000, 300, 0, 37]
    assert max(shards.values()) - min(shards.values()) <= 1


def test_hypergeometric_distribution(spark):
    n = 20_000
    x = spark.range(n).select(mixing.hypergeometric(F.lit(60), F.lit(20), F.lit(15), mixing._uniform(F.col("id"))).alias("x"))
    seen = Counter(r.x for r in x.collect())
    for k in range(16):
        p = math.comb(20, k) * math.comb(40, 15 - k) / math.comb(60, 15)
        assert abs(seen[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(docs, rows):
    got = {r.doc_id: r for r in fp.fingerprints(docs).collect()}
    order = sorted(rows, key=lambda r: -r.doc_id)
    errors = []
    for k, r in enumerate(order):
        text, following = r.text or "", order[(k + 1) % len(order)].text or ""
        third = len(text) // 3
        changed = text[:len(text) - third] + following[:third]
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert len(g.fingerprint) == 2 * fp.BINS
        errors += [g.near_edited - jaccard(text, changed), g.near_next - jaccard(text, following)]
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.05


def test_fingerprints_do_not_depend_on_ranges(docs):
    columns = ["id", "text", "next_text"]
    one, many = fp.with_next(docs), fp.with_next(docs, per_bucket=7)
    assert one.select(columns).exceptAll(many.select(columns)).count() == 0


def test_fingerprints_odd(odd, none):
    got = fp.fingerprints(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.fingerprint)
    assert by_id[3] == by_id[4] and by_id[14] == by_id[15] and len(by_id[9]) == 1
    assert by_id[0] == by_id[1] == by_id[2] == {"0" * 2 * fp.BINS}
    assert fp.fingerprints(none).collect() == []


def test_native_plans_hold_no_python(spark, sf_dir, docs):
    for df in (fp.fingerprints(docs), mixing.mix_plan(docs, ["doc_id"]),
               quality_rules.apply_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
