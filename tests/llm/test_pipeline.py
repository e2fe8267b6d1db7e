"""The pipeline against a brute-force version of its stages, and on odd documents."""

from collections import Counter

import brute
import corpus_pipeline as cp
import pytest
from tokenizers import Tokenizer

from feedloom.llm import mixing, quality_model, quality_rules
from feedloom.llm.common import stored, table


def test_stages_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    labels = table(spark, sf_dir, "labels")

    first = stored(spark, cp.quality_classifier(spark, docs, sf_dir), "t1")
    model = quality_model.fit(docs)
    kept = {r.doc_id for r in quality_model.score(docs, model).filter(f"score >= {quality_model.CUTOFF}").collect()}
    assert {r.doc_id for r in first.collect()} == kept and first.columns == columns

    second = stored(spark, cp.quality_rules(spark, first, sf_dir), "t2")
    judged = {r.doc_id: r.kept for r in quality_rules.apply_rules(first, labels).collect()}
    assert {r.doc_id for r in second.collect()} == {i for i, k in judged.items() if k} and second.columns == columns
    assert all(not brute.base_statistics(r.text)[5] for r in second.collect())

    third = stored(spark, cp.ngram_jaccard(spark, second, sf_dir), "t3")
    rows = second.select("doc_id", "text").collect()
    sets = {r.doc_id: brute.shingles(r.text, 5) for r in rows}
    left = {r.doc_id for r in third.collect()}
    assert third.columns == columns

    def near(a, b):
        both = len(sets[a] & sets[b])
        return 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)

    ids = sorted(sets)
    group = {i: i for i in ids}
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and group[a] != group[b] and near(a, b):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert left == set(group.values())

    fourth = stored(spark, cp.source_mix(spark, third, sf_dir), "t4")
    plan = {r.doc_id: len(r.shards) for r in mixing.mix_plan(third, ["doc_id"]).collect()}
    copies = Counter(r.doc_id for r in fourth.collect())
    assert copies == Counter({i: n for i, n in plan.items() if n}) and fourth.columns == columns

    last = cp.bpe_encode(spark, fourth, sf_dir).collect()
    public_tokenizers = pytest.importorskip("public_tokenizers")
    library = Tokenizer.from_file(public_tokenizers.path(cp.VOCABULARY))
    texts = {r.doc_id: r.text for r in rows}
    assert Counter(r.doc_id for r in last) == copies
    for r in last[:60]:
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_run(spark, sf_dir):
    assert {"doc_id", "lang", "source", "n_tokens", "ids"} == set(cp.run(spark, sf_dir).columns)


@pytest.mark.parametrize("name", ["odd", "none"])
def test_odd_documents_pass_every_stage(spark, sf_dir, request, name):
    docs = request.getfixturevalue(name)
    first_columns = docs.columns
    for k, (stage, function) in enumerate(cp.STAGES):
        docs = stored(spark, function(spark, docs, sf_dir), f"odd-{k}")
        if k < len(cp.STAGES) - 1:
            assert docs.columns == first_columns, stage
    docs.collect()


def test_stages_on_odd_rows_alone(spark, sf_dir, odd):
    for stage, function in cp.STAGES[:-1]:
        out = function(spark, odd, sf_dir)
        assert out.columns == odd.columns, stage
        out.collect()


def test_rows_without_id_and_clashing_ids_keep_their_texts(spark, sf_dir):
    good = [r.text for r in table(spark, sf_dir, "documents").orderBy("doc_id").collect()
            if not brute.base_statistics(r.text)[5]]
    different = []
    for text in good:
        mine = brute.shingles(text, 5)
        if all(100 * len(mine & s) < 50 * len(mine | s) for s in map(lambda t: brute.shingles(t, 5), different)):
            different.append(text)
        if len(different) == 9:
            break
    near = different[0] + " tail"
    rows = [(None, t, "en", "s") for t in different[:3]] + [(7, t, "en", "s") for t in different[3:6]]
    rows += [(k, t, "en", "s") for k, t in enumerate(different[6:], 20)] + [(None, near, "en", "s"), rows[0], (None, "short", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    second = stored(spark, cp.quality_rules(spark, docs, sf_dir), "k2")
    assert Counter(r.text for r in second.collect()) == Counter(t for _, t, *_ in rows if t != "short")
    third = stored(spark, cp.ngram_jaccard(spark, second, sf_dir), "k3")
    texts = [r.text for r in third.collect()]
    assert len(texts) == 9 and {different[0] if t == near else t for t in texts} == set(different)
    plan = mixing.mix_plan(third, ["doc_id"]).collect()
    fourth = cp.source_mix(spark, third, sf_dir).collect()
    assert len(plan) == 9 and len(fourth) == sum(len(r.shards) for r in plan)
    words = lambda text: len((text or "").split())
    assert sum(words(r.text) for r in fourth) == sum(r.size * len(r.shards) for r in plan)
    assert {r.text for r in fourth} == set(texts)


def test_clashing_ids_link_by_their_own_text(spark):
    from feedloom.llm.jaccard import jaccard_groups
    base = " ".join(f"alpha{k}" for k in range(200))
    other = " ".join(f"zeta{k}" for k in range(200))
    docs = spark.createDataFrame([(1, base), (1, other), (2, base + " end"), (None, other + " end"), (None, "lone text here")],
                                 "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_groups(docs).collect()}
    assert got == {(1, 198): 1, (2, 199): 1, (None, 199): 1, (None, 1): None}
