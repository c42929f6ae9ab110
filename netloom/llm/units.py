"""Texts as sequences of distinct units, for tokenizers that treat words alone.

Splitting words out of a text before it is tokenized is safe at a space that
has text on one side at least: the tokenizers' own pattern never joins what
such a space parts. A space inside a longer run of white space is no such
place; a text that has one is left whole, as a unit of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# a space after white space, and before white space or the end
_RUN = r"[\s\x0b\x1c-\x1f\x85\p{Z}] ([\s\x0b\x1c-\x1f\x85\p{Z}]|\z)"
try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library frees in its own way
    _LIBC = None
#: Put where a text is cut; a text that has it is left whole.
_CUT = "\0"
#: Bytes of text that one step takes at once; one longer text is a step of its own.
STEP_BYTES = 8 << 20


def _trim() -> None:
    """Give memory that ended steps leave unused back to the system: workers stay
    alive between tasks, and several of them share an executor's memory."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows again, in batches of at most ``size`` bytes of
    ``column`` or of one row; small ones are put together."""
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, base + size - held_bytes, side="right"))
            if to <= at:
                if held:
                    yield _joined(held)
                    held, held_bytes = [], 0
                    _trim()
                    continue
                to = at + 1
            held.append(batch.slice(at, to - at))
            held_bytes += int(ends[to - 1] - base)
            at = to
            if held_bytes >= size:
                yield _joined(held)
                held, held_bytes = [], 0
                _trim()
    if held:
        yield _joined(held)
    _trim()


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def split_units(texts: pa.Array, whole: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(ends, codes, units): text i is the units that codes[ends[i]:ends[i + 1]]
    name, one after the other, nothing left out. A null text has none, and one
    that has a string of ``whole`` in it is left whole."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    odd = pc.match_substring_regex(texts, _RUN)
    for string in (*whole, _CUT):
        odd = pc.or_(odd, pc.match_substring(texts, string))
    # a text left whole is a list of one; the others are cut before each space, which stays with its word
    marked = pc.replace_substring(pc.if_else(odd, pa.scalar("", pa.large_string()), texts), " ", _CUT + " ")
    cut = pc.split_pattern(marked, _CUT)
    counts = np.asarray(pc.list_value_length(cut)).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    coded = cut.flatten().dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    units = coded.dictionary.to_pylist()
    for i in np.flatnonzero(np.asarray(odd)):
        units.append(texts[int(i)].as_py())
        codes[ends[i]] = len(units) - 1
    return ends, codes, units


def gather(ends: np.ndarray, values: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists values[ends[p]:ends[p + 1]] for each pick, joined, and the ends of
    each pick's list (starting with 0)."""
    lengths = np.diff(ends)[picks]
    out_ends = np.concatenate([[0], np.cumsum(lengths)])
    index = np.arange(out_ends[-1]) + np.repeat(ends[picks] - out_ends[:-1], lengths)
    return values[index], out_ends
