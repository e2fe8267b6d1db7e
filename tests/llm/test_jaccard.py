"""Signature trees and the Jaccard groups against the comparison of every pair."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from feedloom.llm import jaccard
from feedloom.llm.common import components


def labels_by_pairs(sets, percent):
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= percent * (len(a) + len(sets[j]) - both) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("folded", [False, True])
def test_exact_links(percent, folded, monkeypatch):
    if folded:
        monkeypatch.setattr(jaccard, "MATRIX_BYTES", 1)
    chance = np.random.default_rng(percent)
    sets = []
    for _ in range(25):
        base = np.unique(chance.integers(0, 1 << 40, chance.integers(5, 400)).astype(np.uint64))
        for _ in range(chance.integers(1, 20)):
            keep = chance.random(len(base)) > chance.choice([0.0, 0.03, 0.06, 0.12])
            more = chance.integers(0, 1 << 40, chance.integers(0, 1 + len(base) // 15)).astype(np.uint64)
            made = np.unique(np.r_[base[keep], more])
            if len(made):
                sets.append(made)
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0])))
    sets = [sets[i] for i in order]
    assert jaccard.exact_links(sets, percent).tolist() == labels_by_pairs(sets, percent)


def copies(count, words, edits, seed):
    """Near copies of one text, each with some words of its own."""
    chance = random.Random(seed)
    base = [f"w{chance.randrange(9999)}" for _ in range(words)]
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(chance.randrange(edits + 1)):
            text[chance.randrange(words)] = f"x{chance.randrange(99999)}"
        out.append(" ".join(text))
    return out


def check(spark, texts, k=3, percent=90):
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(
        spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()}
    if k == 3:
        assert got == brute.jaccard_components(rows, percent)
    return got


def test_documents(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()}
    assert got == brute.jaccard_components([(r.doc_id, r.text) for r in rows])


def test_near_copies_and_grids(spark, monkeypatch):
    texts = copies(60, 120, 6, 1) + copies(40, 400, 20, 2) + copies(25, 1_500, 60, 3) + ["a b c"] * 30 \
        + [" ".join(f"the and of {k}" for k in range(j, j + 40)) for j in range(40)]
    want = check(spark, texts)
    monkeypatch.setattr(jaccard, "MOST_IN_BUCKET", 7)
    monkeypatch.setattr(jaccard, "MOST_TOKENS", 2_000)
    assert check(spark, texts) == want


def test_neighbouring_signature_widths_meet(spark):
    n = int(jaccard.WIDTHS[0] * jaccard.FULL)
    words = [f"w{k}" for k in range(n + 40)]
    got = check(spark, [" ".join(words[:n - 10]), " ".join(words[:n + 30])])
    assert got[1][1] == 0


def test_odd(odd, none):
    got = jaccard.jaccard_groups(odd).collect()
    want = brute.jaccard_components(odd.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        (r.doc_id, *want[r.doc_id]) for r in odd.collect())
    assert jaccard.jaccard_groups(none).collect() == []


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 50), (50, 70), (7, 7)]
    got = dict(components(spark, spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {k: 0 for k in range(41)} | {50: 50, 70: 50, 100: 50}
