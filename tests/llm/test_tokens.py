"""Token counts, the BPE codec and its transducer against the tokenizers library."""

import hashlib
import os
import random

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")
from array import array  # noqa: E402

from tokenizers import Tokenizer  # noqa: E402

from feedloom.llm import bpe  # noqa: E402
from feedloom.llm.token_counts import stored_counts, token_counts, tokenizer_version  # noqa: E402
from feedloom.llm.transducer import compile_transducer, mapped  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_and_cache(spark, docs, rows, library, tmp_path):
    cache = f"file://{tmp_path}/cache"
    got = {r.doc_id: r for r in token_counts(docs.filter("doc_id % 2 = 0"), PATH, cache).collect()}
    version = tokenizer_version(PATH)
    first = stored_counts(spark, cache, version).count()
    assert first == len({r.text or "" for r in rows if r.doc_id % 2 == 0})
    got |= {r.doc_id: r for r in token_counts(docs, PATH, cache).collect()}
    assert stored_counts(spark, cache, version).count() == len({r.text or "" for r in rows})
    assert stored_counts(spark, cache, "another version").count() == 0
    for r in rows:
        n = len(ids(library, r.text))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (
            n, len((r.text or "").encode()), n > 512)
    # Every text is encoded once: a second run appends nothing.
    assert spark.read.parquet(cache).count() == len({r.text or "" for r in rows})


def test_counts_odd(odd, none, library, tmp_path):
    got = token_counts(odd, PATH, f"file://{tmp_path}/a").collect()
    want = sorted((r.doc_id, len(ids(library, r.text))) for r in odd.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in got) == want
    assert token_counts(none, PATH, f"file://{tmp_path}/b").collect() == []


def test_counts_with_other_vocabularies(docs, rows, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in token_counts(docs.limit(40), path, f"file://{tmp_path}/w").collect()}
    texts = {r.doc_id: r.text for r in rows}
    assert got == {i: len(other.encode(texts[i], add_special_tokens=False).ids) for i in got}


@pytest.mark.parametrize("most_words", [0, 5_000])
def test_codec(docs, rows, library, most_words):
    lexicon = bpe.build_lexicon(docs, PATH, most_words)
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, PATH, lexicon), PATH).collect()}
    for r in rows:
        want = ids(library, r.text)
        assert list(array("I", bytes(got[r.doc_id].ids))) == want
        assert got[r.doc_id].n_tokens == len(want)
        assert got[r.doc_id].decoded == library.decode(want, skip_special_tokens=False) == (r.text or "")


def test_codec_odd(odd, none, library):
    lexicon = bpe.build_lexicon(odd, PATH, 100)
    got = bpe.decode(bpe.encode(odd, PATH, lexicon), PATH).collect()
    digest = lambda x: hashlib.sha256(array("I", x).tobytes()).hexdigest()
    want = sorted((r.doc_id, digest(ids(library, r.text)), r.text or "") for r in odd.collect())
    assert sorted((r.doc_id, hashlib.sha256(bytes(r.ids)).hexdigest(), r.decoded) for r in got) == want
    assert bpe.encode(none, PATH, bpe.build_lexicon(none, PATH)).collect() == []


def test_pieces_are_exact_on_hard_texts(library):
    block = compile_transducer((w.encode(), bpe.vocabulary(PATH).merged(w.encode())) for w in (" the", "hello", "'s"))
    coder, chance = bpe._piece_coder(PATH, block), random.Random(1)
    parts = [" ", "  ", "\n", " \n", "a", "the", "É", "\t", "\x1c", "\x1f", "\x85", "\xa0", "　", "'s", "12", "½", "!?",
             "<|endoftext|>", "日本", "\U0001F600", "x" * 60, "​", "\x00", "-"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randrange(14))) for _ in range(1_500)]
    for text in [*texts, "ab" * 5_000, " " * 999]:
        assert list(array("I", b"".join(coder.each(text)))) == ids(library, text)


def test_decode_of_broken_ids(spark, library):
    frame = spark.createDataFrame([(1, bytearray(array("I", [128, 50_256, 999_999, 255]).tobytes())), (2, None)],
                                  "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in bpe.decode(frame, PATH).collect()}
    assert got == {1: library.decode([128, 50_256, 999_999, 255], skip_special_tokens=False), 2: ""}


def test_transducer_is_minimal_and_exact():
    words = {f"{a}{b}".encode(): [k, k + 1] for k, (a, b) in enumerate(
        (a, b) for a in ("walk", "talk", "jump") for b in ("", "s", "ed", "ing", "ings"))}
    lexicon = mapped(compile_transducer(words.items()))
    assert {w: lexicon.get(w) for w in words} == words
    assert lexicon.get(b"") is None and lexicon.get(b"wal") is None and lexicon.get(b"walkx") is None
    assert sorted(lexicon.ordinal(w) for w in words) == list(range(len(words)))
    # One shared tail for all stems: letters of the stems, of the endings, and the end.
    assert lexicon.n_states < 17
    empty = mapped(compile_transducer([]))
    assert empty.get(b"a") is None and empty.n_words == 0


def test_transducer_remembers_stems():
    """Words that share their first bytes are looked up from there on; none, shorter and longer words as before."""
    words = [b" abcd", b" abcde", b" abx", b" ab", b"zzzz", b"zzzzz", b""]
    found = mapped(compile_transducer((w, [k]) for k, w in enumerate(words)))
    for _ in range(2):
        for k, word in enumerate(words):
            assert found.get(word) == [k]
        for word in (b" abc", b" abcdf", b" abcdef", b"zzz", b"zzzzzz", b"q", b"qqqqqq", b" abcf", b" abcfg"):
            assert found.get(word) is None
    assert found.stems


def test_decode_passes_over_unknown_ids():
    vocab = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a word", "x" * 60, "é日本", "aaaa bbbb", "'s it's"):
        for word in bpe.WORD.findall(text):
            ids = vocab.merged(word.encode())
            assert ids == vocab._merged_long([vocab.byte_id[b] for b in word.encode()])
            assert b"".join(vocab.bytes_at[i] for i in ids) == word.encode()


def test_words_merged_together():
    """Many words at once have the ids of each alone: all lengths, ties, bytes that nothing merges."""
    vocab, chance = bpe.vocabulary(PATH), random.Random(2)
    words = [bytes(chance.choice(b"ab e\xc3\xa9ingth\x00\xff") for _ in range(chance.randrange(1, 70))) for _ in range(5_000)]
    words += [b"aaaaaaa", b" the", b"x", b"ab" * 200]
    ids, starts, sizes = vocab.merged_many(words)
    assert [ids[at:at + n].tolist() for at, n in zip(starts, sizes)] == [vocab.merged(word) for word in words]
    assert [len(part) for part in vocab.merged_many([])] == [0, 0, 0]


def test_words_looked_up_together():
    words = [b"", b" abcd", b" abx", b"zzzz", b"q", b" ab", "é日".encode()]
    found = mapped(compile_transducer((w, [k]) for k, w in enumerate(words)))
    asked = [*words, b" abc", b" abcde", b"zz", b"qq", b"", b"\xff"]
    assert found.ordinals(asked).tolist() == [found.ordinal(word) for word in asked]
    assert mapped(compile_transducer([])).ordinals([b"a", b""]).tolist() == [-1, -1]


def test_texts_together_with_few_remembered(library, monkeypatch):
    """Ids stay the same however few pieces are remembered and however texts are grouped."""
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    monkeypatch.setattr(bpe, "GROUP", 40)
    block = compile_transducer((w.encode(), bpe.vocabulary(PATH).merged(w.encode())) for w in (" the", "hello", ","))
    coder, chance = bpe._piece_coder(PATH, block), random.Random(3)
    parts = ["the", "hello,", "a\n", " ", "  b", "<|endoftext|>", "\x1c", "\xa0", "日本", "it's", "12,5", ""]
    texts = [" ".join(chance.choice(parts) for _ in range(chance.randrange(9))) for _ in range(2_000)]
    assert [list(array("I", got)) for got in coder.texts(texts)] == [ids(library, text) for text in texts]
    assert len(coder.known) + len(coder.before) < 60
    assert coder.texts([]) == []
