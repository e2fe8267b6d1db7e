"""Toxicity, quality model and license scan."""

import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import license_scan, quality_model, toxicity

LABELS = "doc_id long, quality int, toxic int"


def auc(scores, truth):
    rank = np.empty(len(scores))
    rank[np.argsort(scores, kind="stable")] = np.arange(1, len(scores) + 1)
    k = truth.sum()
    return (rank[truth == 1].sum() - k * (k + 1) / 2) / (k * (len(truth) - k))


def test_toxicity_finds_held_out_documents(spark):
    chance = np.random.default_rng(7)
    syllables = ["an", "the", "or", "ing", "tion", "er", "st", "ea", "ou", "nd"]
    bad = ["grobnik", "vilefrat", "zurmox", "plagwit"]

    def text(toxic):
        words = ["".join(chance.choice(syllables, chance.integers(1, 4))) for _ in range(120)]
        for _ in range(4 * toxic):
            words[chance.integers(120)] = str(chance.choice(bad))
        return " ".join(words)

    truth = [int(k % 6 == 0) for k in range(1_800)]
    docs = spark.createDataFrame([(k, text(t)) for k, t in enumerate(truth)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(truth)] + [(0, 1, 1), (3, None, None)], LABELS)
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [k for k in range(1_800) if k % 5 == 0]
    assert auc(np.array([got[k] for k in held]), np.array([truth[k] for k in held])) > 0.97
    again = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)
    assert np.allclose(again["weights"], model["weights"])


def test_training_keeps_different_texts_that_open_alike(spark):
    line = "the same opening line of a hot source that goes on for more than sixty characters "
    rows = [(k, line + f"then text {k}") for k in range(20)] + [(20, line + "then text 3"), (21, None), (22, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k, _ in rows], LABELS)
    got = toxicity.training_rows(docs, labels, F.lit(True)).collect()
    assert Counter((r.text or "", r.toxic) for r in got) == Counter({(t or "", k % 2) for k, t in rows})


def test_segments_hold_all_words():
    words = [b"bad%d" % (k % 50) for k in range(5_000)] + [b"late"]
    pieces = toxicity.segments_of(" ".join(w.decode() + " fine" for w in words), frozenset(words))
    assert b" ".join(pieces).split() == words and all(len(p) < toxicity.SEGMENT + 10 for p in pieces)
    assert toxicity.segments_of(None, frozenset(words)) == []


def test_toxicity_odd(spark, odd, none):
    known = spark.createDataFrame([(3, 1, 1), (5, 1, 0), (6, 0, None)], LABELS)
    for labels in (known, known.limit(0), known.filter("toxic = 1")):
        got = toxicity.score(odd, toxicity.fit(odd, labels, F.lit(True))).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (0, 1)}) == 1
        assert toxicity.score(none, toxicity.fit(none, labels, F.lit(True))).collect() == []


def test_windows_cover_the_text():
    for text in ("", "a", "word " * 500, "x" * 1_000, "é" * 333):
        assert b"".join(toxicity.windows(text)) == text.encode()


def test_quality_model_agrees_with_labels_it_never_saw(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    model = quality_model.fit(docs)
    got = {r.doc_id: r.score >= quality_model.CUTOFF for r in quality_model.score(docs, model).collect() if r.doc_id in truth}
    good = [got[i] for i in got if truth[i] == 1]
    bad = [got[i] for i in got if truth[i] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15
    assert {r.doc_id for r in quality_model.keep(docs, model).select("doc_id").collect()} == {
        r.doc_id for r in quality_model.score(docs, model).collect() if r.score >= quality_model.CUTOFF}


def test_estimate_recovers_accuracies(monkeypatch):
    chance = np.random.default_rng(2)
    names = [f"l{k}" for k in range(7)]
    monkeypatch.setattr(quality_model, "LABELLERS", dict.fromkeys(names))
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.9])
    good = chance.random(20_000) < 0.7
    counts: Counter = Counter()
    for g in good:
        pattern = 0
        for r in right:
            vote = quality_model.ABSTAIN if chance.random() < 0.2 else 2 if (chance.random() < r) == g else 1
            pattern = 3 * pattern + int(vote)
        counts[pattern] += 1
    posterior, accuracy = quality_model.estimate(counts)
    assert np.allclose([accuracy[n] for n in names], np.c_[right, right], atol=0.03)
    assert abs(sum(posterior[p] * c for p, c in counts.items()) / 20_000 - 0.7) < 0.03
    assert quality_model.estimate({}) == ({}, {})


def test_quality_odd(spark, odd, none):
    model = quality_model.fit(odd)
    got = quality_model.score(odd, model).collect()
    assert len(got) == odd.count() and all(r.score == 0 for r in got if r.doc_id in (0, 1, 2))
    assert quality_model.keep(odd, model).columns == odd.columns
    assert quality_model.score(none, quality_model.fit(none)).collect() == []


def scan(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in license_scan.scan_licenses(rows, **options).collect()}


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_places(text):
    words = WORD.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k:k + len(p)] == p:
                starts.append(k), labels.add(label)
    return len(words), sorted(starts), sorted(labels)


def brute_matches(text, notices, containment):
    out = []
    for number, line in enumerate((text or "").split("\n")):
        block = set(WORD.findall(lower(line)))
        for label, notice in notices.items():
            tokens = set(WORD.findall(lower(notice)))
            if tokens and len(block & tokens) >= -(-int(round(containment * 1000)) * len(tokens) // 1000):
                out.append((number, label))
    return sorted(out)


def test_license_scan_against_brute_force(spark, rows):
    texts = [r.text for r in rows] + [
        None, "", "MIT license, mit--LICENSE; CC\nby cc by", "cc cc by by", "Apache-License apache\tlicense",
        *license_scan.NOTICES.values(), " ".join(license_scan.NOTICES.values()),
        "Permission is hereby granted free of charge to any person obtaining a copy of this software\nand more",
        "licensed under the terms of version 3", "mit license " * 5_000]
    for containment in (0.5, 0.8, 1.0):
        got = scan(spark, texts, containment=containment)
        for k, text in enumerate(texts):
            assert (got[k].n_words, got[k].starts, got[k].phrase_labels) == brute_places(text)
            assert sorted((m.block, m.label) for m in got[k].matches) == brute_matches(
                text, license_scan.NOTICES, containment)


def brute_wrapped(text, notices, containment):
    """Every run of lines with words that cannot be made longer, against every notice."""
    lines = [set(WORD.findall(lower(line))) for line in (text or "").split("\n")]
    out = []
    for first in range(len(lines)):
        for last in range(first + 1, len(lines)):
            ends = (first == 0 or not lines[first - 1]) and (last == len(lines) - 1 or not lines[last + 1])
            if ends and all(lines[first:last + 1]):
                block = set().union(*lines[first:last + 1])
                for label, notice in notices.items():
                    tokens = set(WORD.findall(lower(notice)))
                    if len(block & tokens) >= -(-int(round(containment * 1000)) * len(tokens) // 1000):
                        out.append((first, last, label))
    return sorted(out)


def test_wrapped_notices(spark, rows):
    import textwrap
    texts = [f"/*\n{textwrap.indent(textwrap.fill(notice, width), mark)}\n */\n\nint main;\nreturn 0"
             for notice in license_scan.NOTICES.values() for width in (30, 72) for mark in (" * ", "# ", "// ", "")]
    texts += [r.text for r in rows[:60]] + ["released under\n\nthe mit license", "released under\r\nthe MIT\r\nlicense", None, "", "\n\n"]
    got = scan(spark, texts)
    for k, text in enumerate(texts):
        assert sorted((m.first, m.last, m.label) for m in got[k].wrapped) == brute_wrapped(text, license_scan.NOTICES, 0.8)
    for k, label in enumerate(label for label in license_scan.NOTICES for _ in range(8)):
        found = {m.label: m.containment for m in [*got[k].matches, *got[k].wrapped]}
        assert found[label] == 1, label


def test_license_odd(odd, none):
    got = license_scan.scan_licenses(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in odd.collect())
    assert license_scan.scan_licenses(none).collect() == []


@pytest.mark.parametrize("text", ["one\ttwo", "a!b", "É é 日本", "x" * 10_000])
def test_words(text):
    assert [w.decode() for w in license_scan.words(text)] == WORD.findall(lower(text))


def test_brute_base_is_sound():
    assert brute.base_statistics("a b c a b c")[:5] == (6, 6, 0, 0, 6)


def test_ordinary_words_by_the_short_way():
    """Marks, shapes and features of ordinary words are those that reading them letter by letter gives."""
    words = ["word", "Word", "word.", "Word!", "A", "a", "A.", "été,", "Été", "ß?", "WORD", "wOrd", "word..", "ǅa", "日本", "A中b",
             "A中B", "1a", ".", "!?", "a1.", "ªb", "x́", "\ud800", "İi", "iİ", "word#", "Ab:", "aB;"]

    def slow_marks(word):
        letters = [c for c in word if c.isalpha()]
        upper = sum(c.isupper() for c in letters)
        odd = not any(c.isalnum() for c in word) or any(c in r"#*$%&|<>{}\^~" for c in word)
        loud = any(a in "!?" and b in "!?" for a, b in zip(word, word[1:]))
        return (1 * odd | 2 * (len(letters) > 1 and upper == len(letters)) | 4 * loud | 8 * (word[-1] in ".?!")
                | 16 * (len(letters) > upper and upper <= 1))

    def slow_shape(word):
        kinds = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word]
        return "".join([k for at, k in enumerate(kinds) if at == 0 or kinds[at - 1] != k][:8])

    assert quality_model._plain("Été.") == ("Aa", ".") and quality_model._plain("WORD") is None
    for word in words:
        assert quality_model._marks(word) == slow_marks(word), word
        assert quality_model._shape(word) == slow_shape(word), word
        assert quality_model.features(word) == tuple(quality_model._hashed(f) for f in (
            "w:" + word.lower(), "s:" + slow_shape(word), "e:" + word[-3:]))


def test_training_sample_is_one_python_step(spark, docs):
    """A task of the sample needs one Python worker; the rows are those that the votes and the hash choose."""
    from feedloom.llm import quality_model as q
    from feedloom.llm.common import python_ready

    python_ready(spark)
    rows = docs.selectExpr("doc_id", "coalesce(text, '') AS text")
    share = {p: 0.3 + 0.5 * (p % 2) for p in range(3 ** len(q.LABELLERS))}
    sample = q.training_sample(rows, share)
    assert sample._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    marks, place = q.Pieces(q._marks), "pmod(xxhash64(doc_id, text, 'train'), 1073741824) / double(1073741824)"
    want = {}
    for r in rows.selectExpr("*", f"{place} AS place").collect():
        pattern = q.vote_pattern(r.text, marks)
        if r.place < share[pattern]:
            want[r.doc_id] = pattern
    got = {r.doc_id: (r.pattern, len(r.i) == len(r.v)) for r in sample.collect()}
    assert got == {k: (p, True) for k, p in want.items()} and 0 < len(got) < rows.count()
