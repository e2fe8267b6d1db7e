"""Byte-level BPE: frequent words from a mapped transducer, all others by exact merging; and back.

``build_lexicon`` counts the words of the whole corpus and compiles the most frequent ones, with their
ids, into a minimal acyclic transducer. ``encode`` splits texts as the vocabulary's pre-tokenizer does,
looks the words of a group of texts up together and merges together what the lexicon lacks, so its size
changes speed and never ids.
``decode`` joins the tokens' bytes; bytes that are no UTF-8 become the replacement character.

Nulls and empty texts have no ids and decode to the empty text. Repeated rows are all encoded. A text
of any length is encoded whole, cut only where no token can cross (see ``pieces``). Extra columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready, stored
from feedloom.llm.pieces import cut
from feedloom.llm.transducer import compile_transducer, mapped

# Fixed value: the split pattern of this family of byte-level vocabularies.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SHORT = 48
NEVER = 1 << 30
LEAST_COUNT = 4
GROUP = 1 << 20  # characters of texts encoded together
KNOWN_PIECES = 150_000  # pieces a task remembers, twice: those met lately and those before
COUNTED_PIECES = 300_000  # pieces a task counts before it hands the counts on
MERGED_ROWS = 4_096
_NO_RANKS: dict[int, int] = {}


def byte_characters() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file, by its public rule."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(byte): byte for byte in shown} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


class Vocabulary:
    """Ids, merge ranks and token bytes of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        model, split = layout["model"], layout["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or layout["normalizer"]:
            raise ValueError(f"{path} is no byte-level BPE without normalizer and prefix space")
        of_char = byte_characters()
        self.special = {token["content"]: token["id"] for token in layout["added_tokens"]}
        self.bytes_of = {number: bytes(of_char[c] for c in token) for token, number in model["vocab"].items()
                         if token not in self.special}
        self.bytes_of |= {number: token.encode() for token, number in self.special.items()}
        self.byte_id = [0] * 256
        for char, byte in of_char.items():
            self.byte_id[byte] = model["vocab"][char]
        self.rank_of, self.merged_id = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ids = model["vocab"]
            self.rank_of[ids[left], ids[right]] = rank
            self.merged_id.append(ids[left + right])
        # the same ranks by left id, and those of two bytes: looked up without making pairs
        self.ranks_after = [_NO_RANKS] * (max(self.bytes_of, default=0) + 1)
        for (left, right), rank in self.rank_of.items():
            if self.ranks_after[left] is _NO_RANKS:
                self.ranks_after[left] = {}
            self.ranks_after[left][right] = rank
        self.byte_ranks = [[self.rank_of.get((a, b), NEVER) for b in self.byte_id] for a in self.byte_id]
        # bytes of every id from 0, none of ids that the vocabulary lacks
        self.bytes_at = [self.bytes_of.get(number, b"") for number in range(len(self.ranks_after))]
        # the same as arrays, for many words at once; after the last id comes one that no pair holds
        self.no_id = len(self.bytes_at)
        pairs = np.array([(left << 32) + right for left, right in self.rank_of], np.uint64)
        order = np.argsort(pairs)
        self.pairs = np.r_[pairs[order], np.uint64(NEVER << 32)]
        self.pair_ranks = np.r_[np.array(list(self.rank_of.values()), np.int64)[order], NEVER].astype(np.int32)
        self.merged_ids = np.array([*self.merged_id, self.no_id], np.uint32)
        self.byte_ids = np.array([*self.byte_id, self.no_id], np.uint32)
        self.token_bytes = pa.array([*self.bytes_at, b""], pa.large_binary())
        self.special_split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None

    def merged(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank first, the leftmost of equal pairs."""
        ids = [self.byte_id[byte] for byte in word]
        if len(ids) > SHORT:
            return self._merged_long(ids)
        byte_ranks = self.byte_ranks
        return self._merged_short(ids, [byte_ranks[a][b] for a, b in zip(word, word[1:])])

    def _merged_short(self, ids: list[int], ranks: list[int]) -> list[int]:
        after, merged_id = self.ranks_after, self.merged_id
        while ranks:
            rank = min(ranks)
            if rank == NEVER:
                break
            at = ranks.index(rank)
            ids[at] = merged = merged_id[rank]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = after[ids[at - 1]].get(merged, NEVER)
            if at < len(ranks):
                ranks[at] = after[merged].get(ids[at + 1], NEVER)
        return ids

    def merged_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, sizes): ``merged`` of every word by its place among the ids, words of like length
        together."""
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        blocks, total = [], 0

        def put(at, block, counts):
            nonlocal total
            starts[at], sizes[at] = total + np.cumsum(counts) - counts, counts
            blocks.append(block)
            total += len(block)

        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for at in np.flatnonzero(lengths > SHORT).tolist():
            ids = np.array(self.merged(words[at]), np.uint32)
            put([at], ids, np.array([len(ids)]))
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= SHORT]
        for low in range(0, len(order), MERGED_ROWS):
            part = order[low:low + MERGED_ROWS]
            codes = np.full((len(part), lengths[part[-1]]), 256, np.uint16)
            codes[np.arange(codes.shape[1]) < lengths[part, None]] = np.frombuffer(b"".join([words[at] for at in part.tolist()]), np.uint8)
            for rows, ids in self._rounds(self.byte_ids[codes]):
                shown = ids != self.no_id
                put(part[rows], ids[shown], shown.sum(axis=1))
        return np.concatenate([np.empty(0, np.uint32), *blocks]), starts, sizes

    def _rounds(self, ids: np.ndarray):
        """(rows, their ids) as rows are done. In a round, every row merges its pair of lowest rank, the
        leftmost of equal ones, and so all rows become shorter by one."""
        rows = np.arange(len(ids))
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            at = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(ids)), at]
            go = rank < NEVER
            if not go.all():
                yield rows[~go], ids[~go]
                rows, ids, ranks, at, rank = rows[go], ids[go], ranks[go], at[go], rank[go]
            n, width = ids.shape
            if not n:
                return
            every, merged = np.arange(n), self.merged_ids[rank]
            ids[every, at] = merged
            stay = np.ones((n, width), bool)
            stay[every, at + 1] = False
            ids = ids[stay].reshape(n, width - 1)
            ranks = ranks[stay[:, 1:]].reshape(n, width - 2)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self._ranks(ids[inner, at[inner] - 1], merged[inner])
            inner = np.flatnonzero(at < width - 2)
            ranks[inner, at[inner]] = self._ranks(merged[inner], ids[inner, at[inner] + 1])
        yield rows, ids

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right
        place = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[place] == keys, self.pair_ranks[place], np.int32(NEVER))

    def text(self, ids: bytes) -> str:
        """The text of ids; those that the vocabulary lacks are passed over."""
        numbers = np.minimum(np.frombuffer(ids, "<u4"), self.no_id)
        tokens = self.token_bytes.take(pa.array(numbers))
        data = tokens.buffers()[2]
        return data.to_pybytes().decode("utf-8", "replace") if data is not None else ""

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        rank_of, n = self.rank_of, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank_of[pair], at, pair) for at, pair in enumerate(zip(ids, ids[1:])) if pair in rank_of]
        heapq.heapify(heap)
        while heap:
            rank, at, pair = heapq.heappop(heap)
            right = after[at]
            if right >= n or (ids[at], ids[right]) != pair:
                continue
            ids[at], ids[right] = self.merged_id[rank], -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n:
                    near = ids[left], ids[after[left]]
                    if near in rank_of:
                        heapq.heappush(heap, (rank_of[near], left, near))
        return [i for i in ids if i >= 0]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Coder:
    """Ids of texts, many at once. Pieces met lately are remembered; words of all others are looked up
    together and, where the lexicon lacks them, merged together."""

    def __init__(self, vocab: Vocabulary, lexicon):
        self.vocab, self.lexicon = vocab, lexicon
        self.known: dict[str, bytes] = {}  # ids of pieces by what follows their space
        self.before: dict[str, bytes] = {}

    def forget(self) -> None:
        """Pieces are forgotten: an idle worker holds none of them beside the workers of later stages."""
        self.known, self.before = {}, {}

    def each(self, text: str) -> list[bytes]:
        """Ids of a text's pieces, in order."""
        first, rest = cut(text)
        firsts = self._learn({first}, set(rest))
        return [firsts[first], *map(self.known.__getitem__, rest)]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of every text."""
        out, group, size = [], [], 0
        for at, text in enumerate(texts, 1):
            group.append(cut(text))
            size += len(text)
            if size >= GROUP or at == len(texts):
                firsts = self._learn({first for first, _ in group}, set().union(*[rest for _, rest in group]))
                of = self.known.__getitem__
                out += [b"".join([firsts[first], *map(of, rest)]) for first, rest in group]
                group, size = [], 0
        return out

    def _learn(self, firsts: set[str], rest: set[str]) -> dict[str, bytes]:
        """Ids of the first pieces; ``known`` holds those of the other pieces after this."""
        if len(self.known) > KNOWN_PIECES:
            self.known, self.before = {}, self.known
        known, before, vocab = self.known, self.before, self.vocab
        missed = rest.difference(known)
        new = list(missed.difference(before))
        for piece in missed.intersection(before):
            known[piece] = before[piece]
        special = any(map(" ".join(new).__contains__, vocab.special))
        even, odd = [], []
        for piece in new:
            if not piece or " " in piece or piece[-1].isspace() or special and any(map(piece.__contains__, vocab.special)):
                odd.append(piece)
            else:
                even.append(piece)
        # No word crosses from an even piece into the next, and each has one space, its first character.
        words = WORD.findall(" " + " ".join(even)) if even else []
        heads = [at for at, word in enumerate(words) if word[0] == " "]
        for piece in [*[" " + piece for piece in odd], *firsts]:
            heads.append(len(words))
            words += self._words(piece)
        numbers = dict(zip(dict.fromkeys(words), range(len(words))))
        pool, starts, sizes = self._ids(list(numbers))
        place = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        starts, sizes = starts[place], sizes[place]
        ends = np.cumsum(sizes)
        block = pool[np.repeat(starts - ends + sizes, sizes) + np.arange(sizes.sum())].astype("<u4").tobytes()
        cuts = (4 * np.r_[0, ends][[*heads, len(words)]]).tolist()
        ids = [block[start:end] for start, end in zip(cuts, cuts[1:])]
        known.update(zip([*even, *odd], ids))
        return dict(zip(firsts, ids[len(new):]))

    def _words(self, piece: str) -> list[str]:
        """Words of a piece by the split pattern; special tokens are words of their own."""
        if not any(map(piece.__contains__, self.vocab.special)):
            return WORD.findall(piece)
        words, at = [], 0
        for found in self.vocab.special_split.finditer(piece):
            words += [*WORD.findall(piece[at:found.start()]), found.group()]
            at = found.end()
        return words + WORD.findall(piece[at:])

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, sizes): ids of every word by their place among all ids."""
        vocab, lexicon = self.vocab, self.lexicon
        raw = [word.encode() for word in words]
        places = lexicon.ordinals(raw)
        ids, offsets = np.asarray(lexicon.ids), np.asarray(lexicon.offsets).astype(np.int64)
        starts = offsets[places]
        sizes = np.where(places < 0, 0, offsets[places + 1] - starts)
        left = np.flatnonzero(places < 0)
        merged, starts[left], sizes[left] = vocab.merged_many([raw[at] for at in left.tolist()])
        starts[left] += len(ids)
        special = [at for at, word in enumerate(words) if word in vocab.special] if vocab.special else []
        starts[special], sizes[special] = len(ids) + len(merged) + np.arange(len(special)), 1
        return np.concatenate([ids, merged, np.array([vocab.special[words[at]] for at in special], np.uint32)]), starts, sizes


def _piece_coder(path: str, block: bytes) -> _Coder:
    return _Coder(vocabulary(path), mapped(block))


_CODERS: dict[tuple[str, str], _Coder] = {}


def _coder(path: str, lexicon) -> _Coder:
    """Per worker, kept over tasks."""
    key = path, lexicon.value["digest"]
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = _piece_coder(path, lexicon.value["block"])
    return _CODERS[key]


def _piece_counts(batches):
    """Counts of space-separated pieces, emitted whenever the table of a task is full."""
    counts: Counter = Counter()

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                           names=["piece", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for text in batch.column("text"):
            counts.update(text.as_py().split(" "))
            if len(counts) > COUNTED_PIECES:
                yield flush()
    yield flush()


def build_lexicon(docs: DataFrame, vocabulary_path: str, most_words: int = 65_536, text_column: str = "text"):
    """A broadcast lexicon of the words in the most frequent pieces of all texts, at most ``most_words``.

    Its size is bounded by the parameter, not by the corpus: a histogram of the counts, in steps of an
    eighth of a power of two, tells from which count on pieces are few enough to be gathered.
    """
    spark = docs.sparkSession
    python_ready(spark)
    vocab = vocabulary(vocabulary_path)
    step = F.floor(F.log2("n") * 8)
    counts = docs.select(F.col(text_column).alias("text")).filter("text is not null") \
        .mapInArrow(_piece_counts, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")) \
        .filter((F.col("n") >= LEAST_COUNT) & (F.length("piece") <= 64)).withColumn("step", step)
    counts = stored(spark, counts, "piece-counts")
    least, total = None, 0
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most_words:
            break
        least = row.step
    pieces = [] if least is None else counts.filter(F.col("step") >= least).orderBy(F.desc("n"), "piece").collect()
    words = dict.fromkeys(word for row in pieces for word in WORD.findall(" " + row.piece))
    block = compile_transducer((word.encode(), vocab.merged(word.encode())) for word in words)
    return spark.sparkContext.broadcast({"block": block, "digest": hashlib.sha256(block).hexdigest()})


def encode(docs: DataFrame, vocabulary_path: str, lexicon, id_column: str = "doc_id",
           text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, ``keep``, n_tokens, ids): ids as little-endian unsigned 32-bit integers in one binary."""
    kept = [id_column, *(keep or [])]

    def run(batches):
        coder = _coder(vocabulary_path, lexicon)
        try:
            for batch in batches:
                ids = coder.texts([text or "" for text in batch.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[*kept, "n_tokens", "ids"])
        finally:
            coder.forget()

    python_ready(docs.sparkSession)
    rows = docs.select(F.col(text_column).alias("_text"), *kept)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{kinds}, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary_path: str, ids_column: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with its ids as text; ids that the vocabulary lacks are passed over."""
    def run(batches):
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            texts = [vocab.text(ids or b"") for ids in batch.column(ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, to])

    python_ready(encoded.sparkSession)
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, `{to}` string")
