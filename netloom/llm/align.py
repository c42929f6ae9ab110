"""Alignment of two tokenizers' tokens over documents, by exact text.

Documents are shuffled by their full text, so each distinct text is tokenized
and aligned once, however many copies it has. Tokenizer A reads a space and
the text, tokenizer B the text (it adds the space itself), so both cover the
same bytes. Byte offsets at which tokens of both end cut them into groups, and
an A token and a B token are linked if their byte ranges overlap. How often a
pair of ids is linked in the corpus is summed over distinct texts, weighed by
their copies; each text is then measured by the counts of its own links, and
its measures are joined to the ids of all documents that hold it.

Within a text, tokens of both end before a space that has other characters than
white space on both sides, so no group or link crosses it: the pieces between
such spaces are tokenized and aligned, and a task keeps what it learned of them
from step to step.
``TokenizerB`` refuses a vocabulary for which that is not so.

Counts of at most ``COMMON`` pairs are joined by broadcast, the others by
shuffle. Measures of the ``HOT`` texts with most copies are joined by
broadcast, so that a text that a third of all documents hold is in no one task;
any other text has at most one in ``HOT`` of them.

Edge cases: a text that is null or empty, or that either tokenizer changes (B
turns U+2581 into a space), has no tokens: zeros, and an empty string for the
hash. Rows that share an id or a text are answered each; a null id is returned
as it is; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netloom.llm.units import gather, steps
from netloom.session import materialize

#: Pairs whose counts are joined by broadcast: two numbers and a flag each.
COMMON = 500_000
#: Texts whose measures are joined by broadcast: about 150 bytes each.
HOT = 1_000
#: Bytes of text that one step takes at once.
STEP = 512 << 10

#: Pieces that a task keeps between steps, of about 300 bytes each; beyond them it
#: starts anew.
KEPT = 200_000


_SPACE = re.compile(r"(?<=\S) (?=\S)")
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class TokenizerA:
    """A byte-level BPE file of the tokenizers library; special tokens' strings
    in a text are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        byte = {c: b for b, c in _byte_letters().items()}
        self.bytes = [b""] * self._tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self._tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(byte[c] for c in token)
        self.lengths = np.array([len(x) for x in self.bytes])

    def encode(self, texts: list[str]) -> list[list[int]]:
        encoded = self._tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in encoded]


class TokenizerB:
    """A SentencePiece model that puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of this model runs across a space")
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.lengths = np.array([len(x) for x in self.bytes])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@lru_cache(maxsize=1)
def _tokenizers(a_path: str, b_path: str) -> tuple[TokenizerA, TokenizerB]:
    """Read once by each worker."""
    return TokenizerA(a_path), TokenizerB(b_path)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if
    it prints in Latin-1, else the next free one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in prints}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(0x100 + len(letters) - len(prints))
    return letters


def _flat(ids: list[list[int]], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, ends, firsts): all texts' ids in a row, where each token ends in the
    bytes of all texts, and the number of each text's first token."""
    flat = np.fromiter(chain.from_iterable(ids), np.int64)
    return flat, np.cumsum(lengths[flat]), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)


class Alignment:
    """The alignment of tokenizations of the same texts, which cover the same
    bytes. Arrays run over the tokens of all texts; ``*_firsts`` cut them by text.
    ``*_lengths`` are the tokens' lengths in bytes by id, none of them 0."""

    def __init__(self, a_ids: list[list[int]], b_ids: list[list[int]], a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a, ends_a, self.a_firsts = _flat(a_ids, a_lengths)
        self.b, ends_b, self.b_firsts = _flat(b_ids, b_lengths)
        size = int(ends_a[-1]) if len(ends_a) else 0
        ends = np.zeros((2, size + 1), bool)
        ends[0][ends_a] = ends[1][ends_b] = True
        # the number of the B token that holds each byte
        holder = np.cumsum(ends[1][:size], dtype=np.int32)
        # a token of A meets the tokens of B from the one that holds its first byte to the one that holds its last
        first = holder[ends_a - a_lengths[self.a]]
        n = holder[ends_a - 1] - first + 1
        self.link_a = np.repeat(self.a, n)
        self.link_b = self.b[np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)]
        self.link_firsts = np.concatenate([[0], np.cumsum(n)])[self.a_firsts]
        # a group ends where tokens of both do
        self.last_a, self.last_b = np.flatnonzero(ends[1][ends_a]), np.flatnonzero(ends[0][ends_b])
        self.group_firsts = np.searchsorted(self.last_a, self.a_firsts)

    def group_texts(self) -> list[str]:
        """Each text's groups, ``a1,a2|b1;a3|b2,b3``."""
        ends = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        ends[0][self.last_a] = ends[1][self.last_b] = True
        # A's tokens of a group come before B's of the same group
        firsts = np.concatenate([[0], self.last_b + 1])
        of_a = np.cumsum(ends[0]) - ends[0]
        of_b = np.cumsum(ends[1]) - ends[1]
        out = np.empty(len(self.a) + len(self.b), object)
        for ids, at, is_last, mark in ((self.a, np.arange(len(self.a)) + firsts[of_a], ends[0], "|"),
                                       (self.b, np.arange(len(self.b)) + (self.last_a[of_b] + 1 if len(self.last_a) else of_b), ends[1], ";")):
            codes, distinct = pd.factorize(ids * 2 + is_last)
            names = np.array([f"{i >> 1}{mark if i & 1 else ','}" for i in distinct.tolist()], object)
            out[at] = names[codes]
        cuts = (self.a_firsts + self.b_firsts).tolist()
        return ["".join(out[x:y].tolist())[:-1] for x, y in zip(cuts, cuts[1:])]


class Pieces:
    """Distinct pieces of text, aligned: whether both tokenizers keep a piece as it
    is, its counts, its links as ``a * |B| + b`` (those of piece i from
    link_firsts[i] on), and its groups as text."""

    def __init__(self, pieces: list[str], a: TokenizerA, b: TokenizerB):
        a_ids, b_ids = a.encode(pieces), b.encode(pieces)
        raw = [b" " + p.encode() for p in pieces]
        self.kept = _spells(a_ids, a, raw) & _spells(b_ids, b, raw)
        for i in np.flatnonzero(~self.kept).tolist():
            a_ids[i] = b_ids[i] = []
        found = Alignment(a_ids, b_ids, a.lengths, b.lengths)
        self.counts = np.stack([np.diff(f) for f in (found.a_firsts, found.b_firsts, found.group_firsts, found.link_firsts)], axis=1)
        self.links, self.link_firsts = found.link_a * len(b.bytes) + found.link_b, found.link_firsts
        self.groups = found.group_texts()

    def add(self, more: Pieces) -> None:
        self.kept = np.concatenate([self.kept, more.kept])
        self.counts = np.concatenate([self.counts, more.counts])
        self.link_firsts = np.concatenate([self.link_firsts[:-1], more.link_firsts + len(self.links)])
        self.links = np.concatenate([self.links, more.links])
        self.groups += more.groups


def _spells(ids: list[list[int]], tokenizer: TokenizerA | TokenizerB, raw: list[bytes]) -> np.ndarray:
    """Whether each piece's tokens spell its bytes."""
    flat, ends, firsts = _flat(ids, tokenizer.lengths)
    token_bytes = tokenizer.bytes
    sizes = np.diff(np.concatenate([[0], ends])[firsts])
    if (sizes == [len(r) for r in raw]).all() and b"".join([token_bytes[i] for i in flat.tolist()]) == b"".join(raw):
        return np.ones(len(raw), bool)
    return np.array([b"".join([token_bytes[i] for i in x]) == r for x, r in zip(ids, raw)], bool)


class _Numbers(dict):
    """Numbers pieces as they come; new ones are ``fresh``."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


def align_texts(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(key, copies, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of
    every row of ``texts`` (text, copies): the text's SHA-256, its measures, and
    its distinct pairs of ids with how often each is linked in it."""
    schema = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(a_path, b_path)
        numbers, pieces = _Numbers(), Pieces([], a, b)
        for batch in steps(batches, size=STEP):
            if len(numbers) > KEPT:
                numbers, pieces = _Numbers(), Pieces([], a, b)
            every = batch.column("text").to_pylist()
            split = [_SPACE.split(t) for t in every]
            picks = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64)
            pieces.add(Pieces(numbers.fresh, a, b))
            numbers.fresh = []
            ends = np.concatenate([[0], np.cumsum([len(p) for p in split])])  # of each text's pieces
            # a text that has a piece that either tokenizer changes has no tokens
            whole = np.diff(np.concatenate([[0], np.cumsum(~pieces.kept[picks])])[ends]) == 0
            whole &= np.array([t != "" for t in every], bool)
            counts = np.diff(np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(pieces.counts[picks], axis=0)])[ends], axis=0) * whole[:, None]
            names = pieces.groups
            hashes = [
                hashlib.sha256(";".join([names[i] for i in picks[x:y].tolist()]).encode()).hexdigest() if w else ""
                for w, x, y in zip(whole.tolist(), ends.tolist(), ends[1:].tolist())
            ]
            # each text's distinct pairs, in order of text and pair
            linked, link_ends = gather(pieces.link_firsts, pieces.links, picks)
            row = np.repeat(np.arange(len(every)), np.diff(link_ends[ends]))
            span = len(b.bytes) * len(a.bytes)
            keys, times = np.unique((row * span + linked)[whole[row]], return_counts=True)
            firsts = pa.array(np.searchsorted(keys, np.arange(len(every) + 1) * span).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.sha256(t.encode()).digest() for t in every], pa.binary()), batch.column("copies").cast(pa.int64()),
                    *[pa.array(counts[:, k]) for k in range(4)], pa.array(hashes, pa.string()),
                    pa.ListArray.from_arrays(firsts, pa.array(keys % span)),
                    pa.ListArray.from_arrays(firsts, pa.array(times.astype(np.int32))),
                ],
                names=["key", "copies", *_COUNTS, "groups_sha256", "pairs", "times"],
            )

    return texts.select("text", "copies").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold the pair, and whether
    that is the most for its B id. A B id has no more pairs than A has ids."""
    links = aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    counts = links.groupBy(F.col("l.pairs").alias("pair")).agg(F.sum(F.col("l.times") * F.col("copies")).alias("n"))
    of_b = Window.partitionBy(F.col("pair") % F.lit(width))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def _least_common(counts: DataFrame, most: int) -> float:
    """The count from which on pairs are common: a power of two that at most
    ``most`` pairs reach."""
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).count().collect()  # 64 at most
    kept, least = 0, 64
    for level, n in sorted(((r["level"], r["count"]) for r in levels), reverse=True):
        if kept + n > most:
            break
        kept, least = kept + n, level
    return float(2**least)


def _measures(aligned: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """(key, n_best, count_sum): each text's links, measured by the counts of
    their pairs. A text's pairs meet the common counts where they lie, and are
    summed before anything is exchanged; its other pairs are joined."""
    least = F.lit(_least_common(counts, most))
    common, rare = counts.where(F.col("n") >= least), counts.where(F.col("n") < least)
    links = aligned.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("key", F.col("l.pairs").alias("pair"), "l.times")
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    ]
    found = links.join(F.broadcast(common), "pair").groupBy("key").agg(*sums)
    if not rare.isEmpty():
        others = links.join(F.broadcast(common.select("pair")), "pair", "left_anti")
        found = found.unionByName(others.join(rare, "pair").groupBy("key").agg(*sums))
    return found.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def compare(docs: DataFrame, a_path: str, b_path: str, most: int = COMMON, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every document."""
    docs = docs.select("doc_id", "text")
    distinct = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned = materialize(align_texts(distinct, a_path, b_path), "aligned_texts")
    counts = materialize(pair_counts(aligned, len(TokenizerB(b_path).bytes)), "aligned_pairs")
    results = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    sums = _measures(aligned, counts, most)
    texts = aligned.select("key", "copies", *_COUNTS, "groups_sha256").join(sums, "key", "left").select(
        "key", "copies", *_COUNTS, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")], "groups_sha256"
    )
    texts = materialize(texts, "aligned_results")
    # the texts with most copies: a bounded number of rows
    top = materialize(texts.orderBy(F.col("copies").desc(), "key").limit(hot), "aligned_hot")
    keyed = docs.select("doc_id", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)).alias("key"))
    at_once = keyed.join(F.broadcast(top.select("key", F.struct(*results).alias("m"))), "key", "left")
    others = at_once.where("m IS NULL").drop("m").join(
        texts.join(F.broadcast(top.select("key")), "key", "left_anti").select("key", F.struct(*results).alias("m")), "key", "left"
    )
    rows = at_once.where("m IS NOT NULL").select("doc_id", "m").unionByName(others.select("doc_id", "m"))
    return rows.select(
        "doc_id", *[F.coalesce(F.col(f"m.{c}"), F.lit(0).cast("long")).alias(c) for c in results[:-1]],
        F.coalesce("m.groups_sha256", F.lit("")).alias("groups_sha256"),
    )
