"""Byte-level BPE by merge replay over a corpus, and decoding.

Spark splits the corpus into steps of a bounded size. A step keeps each
distinct word (match of the pattern) once, as a linked list of bytes within
one array, with an inverted index from merge rank to the positions of the
pairs that this merge joins. The merges are replayed in rank order over the
whole step: one merge is applied at all places that hold its pair, and only
the pairs with the two touched neighbours are looked up and indexed again. A
merge that makes a pair of lower rank holds back those to its right in its word
until that pair is joined.
Words are encoded apart from each other, so the step's size changes nothing
in the result, and no rows cross the network. A worker keeps the ids of a
bounded number of words, which later steps need not merge again.

Edge cases: a null text is empty and gives no ids; ids unknown to the
vocabulary fail when they are decoded; repeated rows and null keys pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from netloom.llm.units import gather, split_units, steps

#: Bytes of text in a step.
STEP = 2 << 20
#: Words whose ids a worker keeps between steps, of so many bytes at most; about 30 MB.
KEPT_WORDS, KEPT_BYTES = 150_000, 32
_NONE = np.iinfo(np.int32).max


def read_ranks(path: str) -> bytes:
    """A rank file (lines of a base64 token and its rank), read by the driver;
    about a megabyte, whatever the corpus."""
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Tokens by rank, and which pairs of tokens join to a token."""

    def __init__(self, ranks: bytes):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.ranks = {base64.b64decode(t): int(r) for t, r in pairs}
        self.tokens = {r: t for t, r in self.ranks.items()}
        #: Ids of words that earlier steps have merged.
        self.known: dict[str, bytes] = {}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        joins = sorted(
            (self.ranks[t[:i]] << 32 | self.ranks[t[i:]], r)
            for t, r in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        )
        self.join_keys = np.array([k for k, _ in joins], np.int64)
        self.join_ranks = np.array([r for _, r in joins], np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's joined token, or _NONE."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
        return np.where(self.join_keys[at] == keys, self.join_ranks[at], _NONE)


@lru_cache(maxsize=2)
def vocabulary(ranks: bytes) -> Vocabulary:
    return Vocabulary(ranks)


class PairIndex:
    """Positions by the rank of the pair that starts there; ranks come out in order."""

    def __init__(self) -> None:
        self.at: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        there = ranks != _NONE
        ranks, positions = ranks[there], positions[there]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(ranks)]
        for i, rank in enumerate(ranks[starts[:-1]].tolist()):
            part = positions[starts[i] : starts[i + 1]]
            if rank in self.at:
                self.at[rank].append(part)
            else:
                self.at[rank] = [part]
                heapq.heappush(self.heap, rank)

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.heap)
        parts = self.at.pop(rank)
        return rank, np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])


def replay(words: Sequence[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ends, ids): the ids of word i are ids[ends[i]:ends[i + 1]]."""
    lengths = np.array([len(w) for w in words], np.int64)
    token = vocab.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    word = np.repeat(np.arange(len(words)), lengths)
    after = np.arange(1, n + 2)  # position n ends the last word
    before = np.arange(-1, n)
    last = np.cumsum(lengths) - 1
    ends_word = np.zeros(n + 1, bool)
    ends_word[last[lengths > 0]] = True
    alive = np.ones(n + 1, bool)
    pair = np.full(n + 1, _NONE, np.int64)
    inner = np.flatnonzero(~ends_word[:n])
    pair[inner] = vocab.joined(token[inner], token[inner + 1]) if len(inner) else pair[inner]
    index = PairIndex()
    index.add(pair[inner], inner)

    def makes_lower(at: np.ndarray, rank: int) -> np.ndarray:
        """Whether a merge, done after those to its left, makes a pair of lower rank."""
        right = after[at]
        out = np.zeros(len(at), bool)
        go = np.flatnonzero(~ends_word[right])
        out[go] = vocab.joined(np.full(len(go), rank), token[after[right[go]]]) < rank
        left = before[at]
        go = np.flatnonzero((left >= 0) & ~ends_word[left])
        # the token to the left may be the part of the merge before
        merged = np.zeros(len(at), bool)
        merged[1:] = left[1:] == right[:-1]
        beside = np.where(merged[go], rank, token[left[go]])
        out[go] |= vocab.joined(beside, np.full(len(go), rank)) < rank
        return out

    while index.heap:
        rank, at = index.pop()
        at = at[alive[at] & (pair[at] == rank)]  # pairs that a neighbour's merge has ended
        if not len(at):
            continue
        if (word[at[1:]] == word[at[:-1]]).any():
            # from the left, each pair that the one before it leaves; in a word up to the
            # first merge that makes a pair of lower rank, which comes before the others
            fresh = np.ones(len(at), bool)
            fresh[1:] = after[at[:-1]] != at[1:]
            runs = np.flatnonzero(fresh)
            odd = (np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) % 2
            picked = at[odd == 0]
            lower = makes_lower(picked, rank)
            if lower.any():
                seen = np.cumsum(lower) - lower  # of the merges before, in all words
                leads = np.flatnonzero(np.append(True, word[picked[1:]] != word[picked[:-1]]))
                sizes = np.diff(np.append(leads, len(picked)))
                go = seen == np.repeat(seen[leads], sizes)
                rest = np.setdiff1d(at, picked[go])
                index.add(np.full(len(rest), rank), rest)
                picked = picked[go]
            at = picked
        right = after[at]
        token[at] = rank
        alive[right] = False
        pair[right] = _NONE
        beyond = after[right]
        after[at] = beyond
        ends_word[at] = ends_word[right]
        before[beyond] = at
        # the pairs with the neighbours on either side
        pair[at] = _NONE
        right_side = at[~ends_word[at]]
        left = before[at]
        left_side = left[(left >= 0) & ~ends_word[left]]
        touched = np.union1d(left_side, right_side)
        if len(touched):
            pair[touched] = vocab.joined(token[touched], token[after[touched]])
            index.add(pair[touched], touched)
    kept = alive[:n]
    counts = np.bincount(word[kept], minlength=len(words)) if n else np.zeros(len(words), np.int64)
    return np.concatenate([[0], np.cumsum(counts)]), token[kept]


def encode_texts(texts: pa.Array, vocab: Vocabulary, pattern: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """(ends, ids) of texts."""
    text_ends, codes, units = split_units(texts)
    words: dict[str, int] = {}
    unit_words: list[int] = []
    unit_ends = np.zeros(len(units) + 1, np.int64)
    for i, unit in enumerate(units):
        unit_words.extend([words.setdefault(w, len(words)) for w in pattern.findall(unit)])
        unit_ends[i + 1] = len(unit_words)
    found = list(map(vocab.known.get, words))
    missing = [i for i, x in enumerate(found) if x is None]
    names = list(words)
    coded = [names[i].encode() for i in missing]
    missing_ends, merged = replay(coded, vocab)
    raw = merged.astype("<u4").tobytes()
    for i, w, at, to in zip(missing, coded, missing_ends[:-1].tolist(), missing_ends[1:].tolist()):
        # a word that is a token as it stands needs no merges
        found[i] = vocab.ranks[w].to_bytes(4, "little") if to - at > 1 and w in vocab.ranks else raw[4 * at : 4 * to]
        if len(w) <= KEPT_BYTES and len(vocab.known) < KEPT_WORDS:
            vocab.known[names[i]] = found[i]
    word_ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)])
    ids = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
    token_ids, word_list_ends = gather(word_ends, ids, np.array(unit_words, np.int64))
    unit_ids, picked = token_ids, word_list_ends[unit_ends]
    out, ends = gather(picked, unit_ids, codes)
    return ends[text_ends], out


def _with(docs: DataFrame, *fields: StructField) -> StructType:
    return StructType([*docs.schema.fields, *fields])


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``docs`` (a column ``text`` and any others) with the text replaced by
    ``n_tokens`` and ``ids``: binary, little-endian unsigned 32-bit integers."""
    others = [c for c in docs.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, find = vocabulary(shared.value), regex.compile(pattern)
        for batch in steps(batches, size=STEP):
            ends, ids = encode_texts(batch.column("text"), vocab, find)
            raw = memoryview(ids.astype("<u4").tobytes())
            binary = [bytes(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(np.diff(ends), pa.int64()), pa.array(binary, pa.binary())],
                names=[*others, "n_tokens", "ids"],
            )

    schema = _with(docs.select(*others), StructField("n_tokens", LongType()), StructField("ids", BinaryType()))
    return docs.select(*others, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """``encoded`` with a column ``decoded``: the bytes of its ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(shared.value).tokens
        for batch in steps(batches, "ids", STEP):
            out = [
                None if x is None else b"".join(map(tokens.__getitem__, np.frombuffer(x, "<u4").tolist()))
                for x in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, _with(encoded, StructField("decoded", BinaryType())))
