"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes other than ASCII white space, with A-Z in lower case.
Words of a whole batch are hashed together: a polynomial over the bytes from
differences of running sums, then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Bytes that are hashed with one table of powers; a longer word has its own.
_BLOCK = 1 << 18
_kept: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """n powers of _BASE and of its inverse modulo 2**64; those of a block are kept."""
    if n <= _BLOCK + 1 and _kept:
        return _kept
    steps = np.full(max(n, _BLOCK + 1), _BASE, np.uint64)
    steps[0] = 1
    powers = np.multiply.accumulate(steps)
    steps[1:] = pow(_BASE, -1, 1 << 64)
    tables = [powers, np.multiply.accumulate(steps)]
    if n <= _BLOCK + 1:
        _kept.extend(tables)
    return tables


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): text i is bytes[ends[i]:ends[i + 1]]; null texts are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


@dataclass
class Words:
    """The words of a batch of texts: those of text i are numbers ends[i] to
    ends[i + 1]; word w is the bytes first[w] to last[w] of raw."""

    raw: np.ndarray
    text_ends: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hashes: np.ndarray
    prefixes: list[np.ndarray]


def scan(texts: pa.Array, blank: np.ndarray = BLANK, prefixes: tuple[int, ...] = ()) -> Words:
    """Words between the bytes that ``blank`` marks, their hashes, and for each
    length in ``prefixes`` the hashes of their first bytes (0 for shorter words)."""
    raw, text_ends = text_bytes(texts)
    n = len(raw)
    if not n:
        none, empty = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return Words(raw, text_ends, np.zeros(len(texts) + 1, np.int64), none, none, empty, [empty for _ in prefixes])
    inside = ~blank[raw]
    cut = np.zeros(n + 1, bool)  # a text's first byte starts a word of its own
    cut[text_ends] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | cut[1:n]
    first, last = np.flatnonzero(starts), np.flatnonzero(stops)
    hashes = np.zeros(len(first), np.uint64)
    heads = [np.zeros(len(first), np.uint64) for _ in prefixes]
    at = 0
    while at < len(first):  # blocks of whole words
        base = int(first[at])
        to = max(at + 1, int(np.searchsorted(last, base + _BLOCK)))
        begin, length = first[at:to] - base, last[at:to] - first[at:to]
        size = int(last[to - 1]) + 1 - base
        powers, inverse = _power_tables(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((_LOWER[raw[base : base + size]].astype(np.uint64) + np.uint64(1)) * powers[:size], out=sums[1:])

        def hashed(stop: np.ndarray, tag: np.ndarray | int) -> np.ndarray:
            return _mix((sums[stop] - sums[begin]) * inverse[begin] + np.asarray(tag).astype(np.uint64))

        hashes[at:to] = hashed(begin + length + 1, length)
        for head, k in zip(heads, prefixes):
            head[at:to] = np.where(length >= k, hashed(np.minimum(begin + k, size), 1 << 32 | k), np.uint64(0))
        at = to
    return Words(raw, text_ends, np.searchsorted(first, text_ends), first, last, hashes, heads)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ends, hashes): the words of text i are hashes[ends[i]:ends[i + 1]]."""
    words = scan(texts)
    return words.ends, words.hashes


def shingle_sets(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(ends, hashes): each text's distinct runs of ``size`` words, in order of
    hash; a text with fewer words has one, all of them; without words none."""
    word_ends, words = word_hashes(texts)
    counts = np.diff(word_ends)
    factor = np.uint64(0xD6E8FEB86659FD93)
    rolled = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for j in range(size):  # runs that cross into the next text are not used
        rolled = _mix(rolled * factor + words[j : j + len(rolled)])
    parts = []
    sizes = np.zeros(len(counts), np.int64)
    for i, (at, n) in enumerate(zip(word_ends.tolist(), counts.tolist())):
        if n >= size:
            run = np.sort(rolled[at : at + n - size + 1])
            fresh = np.ones(len(run), bool)
            np.not_equal(run[1:], run[:-1], out=fresh[1:])
            run = run[fresh]
        elif n:
            run = np.zeros(1, np.uint64)
            for w in words[at : at + n]:
                run = _mix(run * factor + w)
        else:
            continue
        parts.append(run)
        sizes[i] = len(run)
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.cumsum(sizes)]), hashes
