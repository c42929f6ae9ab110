"""Token ids as ORC files.

Documents are range-partitioned and sorted by doc_id, encoded, and written as
ORC: ids in a list column whose stripes hold run-length and bit-packed
integers, a row index every few thousand rows, and a Bloom filter on doc_id.
Readers split files at stripes, skip columns that they don't name, and skip
stripes and row groups by minimum, maximum and Bloom filter of doc_id.

Edge cases: a null text is empty and gives the end id alone; a null doc_id
sorts first; rows that share a doc_id stand next to each other, by text; an
empty table gives a folder without rows. Extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.functions.prefix import running_total
from netloom.llm.units import gather, split_units, steps
from netloom.session import materialize

#: Units whose ids a Python worker keeps, about 125 MB; beyond it others are
#: encoded anew in each step.
KEPT_UNITS = 500_000
#: Bytes of text in a step; the larger, the fewer units are encoded twice.
STEP = 16 << 20
#: Words that are put into one call; more use more memory, fewer more time.
CALL = 5000
# letters of Latin, Greek and Cyrillic scripts that every version of Unicode has as such
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u0391-\u03a1\u03a3-\u03e1\u0400-\u0481\u048a-\u052f]"
_SIGN = r"[!-&(-/:-@\[-`{-~]"  # of ASCII; not ', which may begin a piece of two letters
#: A word, with signs and another word on the next line, if any. The byte-level
#: pattern parts it into just these groups.
_PARTS = re.compile(rf"( ?{_LETTER}+)({_SIGN}+)?(?:(\n)({_LETTER}+)({_SIGN}+)?)?")
SCHEMA = "doc_id long, n_tokens int, ids array<int>"


def read_tokenizer(path: str) -> str:
    """The JSON of a tokenizer, read by the driver; one or two megabytes."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class UnitEncoder:
    """Ids of distinct units by the tokenizers library, in large calls."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        #: What a text with a special token has in it; it is encoded whole.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.has_special = re.compile("|".join(map(re.escape, self.special))).search if self.special else None
        self.known: dict[str, bytes] = {}
        mark = self._plain(["\t"])[0]
        self.mark = int(np.frombuffer(mark, "<u4")[0]) if len(mark) == 4 else None
        self.words = self._of_words(tokenizer_json) if self.mark is not None else None

    @staticmethod
    def _of_words(tokenizer_json: str):
        """The same model for words alone, in the byte-level alphabet and with the
        tab's letter between: their pattern needs no search. None for a tokenizer
        of another kind."""
        from tokenizers import Tokenizer, pre_tokenizers

        made = json.loads(tokenizer_json)
        how = made.get("pre_tokenizer") or {}
        if made.get("normalizer") or how.get("type") != "ByteLevel" or how.get("add_prefix_space") or not how.get("use_regex", True):
            return None
        words = Tokenizer.from_str(json.dumps(made | {"added_tokens": [], "post_processor": None}))
        words.pre_tokenizer = pre_tokenizers.Split(_byte_letters()[ord("\t")], "isolated")
        return words

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh_words(self, words: list[str]) -> dict[str, bytes]:
        """Words, each with a space before it or none, by ``self.words``."""
        out: dict[str, bytes] = {}
        groups = [words[i : i + CALL] for i in range(0, len(words), CALL)]
        letters = _byte_letters()
        for group in groups:
            text = "\t".join(group).encode().decode("latin-1").translate(letters)
            (found,) = self.words.encode_batch_fast([text], add_special_tokens=False)
            self._cut(group, np.array(found.ids, "<u4"), out)
        return out

    def _cut(self, group: list[str], ids: np.ndarray, out: dict[str, bytes]) -> bool:
        """The ids of a group's units, which the mark parts, into ``out``; False if it doesn't."""
        cuts = np.flatnonzero(ids == self.mark)
        if len(cuts) != len(group) - 1:
            return False
        starts, ends = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), 4 * len(ids)]
        raw = ids.tobytes()
        out.update(zip(group, [raw[a:b] for a, b in zip(starts, ends)]))
        return True

    def _fresh(self, units: list[str]) -> dict[str, bytes]:
        """Units are put into one text with tabs between, which the tokenizer's
        pattern keeps apart from them, and cut at the tab's id again."""
        out: dict[str, bytes] = {}
        plain: list[str] = []
        joinable: list[str] = []
        for u in units:
            inner = u[1:] if u[:1] == " " else u
            tidy = inner and not any(x in inner for x in self.special) and "\t" not in inner and not inner[0].isspace() and not inner[-1].isspace()
            (joinable if tidy and self.mark is not None else plain).append(u)
        groups = [joinable[i : i + 2000] for i in range(0, len(joinable), 2000)]
        for group, ids in zip(groups, self._plain(["\t".join(g) for g in groups])):
            if not self._cut(group, np.frombuffer(ids, "<u4"), out):
                plain.extend(group)
        if plain:
            out.update(zip(plain, self._plain(plain)))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ends, ids) of texts."""
        text_ends, codes, units = split_units(texts, self.special)
        found = list(map(self.known.get, units))
        missing = [i for i, x in enumerate(found) if x is None]
        # words and signs are encoded apart, as the tokenizer's pattern parts them
        words: set[str] = set()
        others: set[str] = set()
        cut: list[str | list[str]] = []
        for i in missing:
            u = units[i]
            m = _PARTS.fullmatch(u) if self.words is not None else None
            if m is None or (self.has_special is not None and self.has_special(u)):
                others.add(u)
                cut.append(u)
                continue
            if m.lastindex == 1:
                words.add(u)
                cut.append(u)
                continue
            word, signs, line, word_2, signs_2 = m.groups()
            words.add(word)
            parts = [x for x in (word, signs, line, word_2, signs_2) if x]
            if word_2:
                words.add(word_2)
            others.update(x for x in (signs, line, signs_2) if x)
            cut.append(parts)
        ids_of = self._fresh_words(list(words.difference(self.known))) if words else {}
        ids_of.update(self._fresh(list(others.difference(self.known))))
        often = (np.bincount(codes, minlength=len(units)) > 1).tolist()
        for i, parts in zip(missing, cut):
            if isinstance(parts, str):
                found[i] = ids_of[parts]
            else:
                found[i] = b"".join([ids_of[x] if x in ids_of else self.known[x] for x in parts])
            # worth keeping: short, and in the step more than once
            if often[i] and len(units[i]) <= 64 and len(self.known) < KEPT_UNITS:
                self.known[units[i]] = found[i]
        ends = np.zeros(len(found) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=ends[1:])
        ids, list_ends = gather(ends, np.frombuffer(b"".join(found), "<u4"), codes)
        return list_ends[text_ends], ids


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level tokens: itself if it is
    printable in Latin-1, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(other)}


@lru_cache(maxsize=1)
def unit_encoder(tokenizer_json: str) -> UnitEncoder:
    return UnitEncoder(tokenizer_json)


def encode(docs: DataFrame, tokenizer_json: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids) in the order of ``docs``; ids end with ``end_id``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(shared.value)
        for batch in steps(batches, size=STEP):
            ends, ids = encoder.encode(batch.column("text"))
            n = batch.num_rows
            values = np.insert(ids.astype(np.int32), ends[1:], end_id)
            ends = ends + np.arange(n + 1)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(ends), pa.int32()), lists], names=["doc_id", "n_tokens", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 0, stride: int = 5000, fpp: float = 0.01) -> None:
    """Encode ``docs`` and write the ids under ``path``, which is on a file
    system that all executors share, in ascending doc_id order."""
    in_order = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        encode(in_order, tokenizer_json, end_id)
        .write.option("orc.compress", "lz4")
        .option("orc.row.index.stride", stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", fpp)
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids); a filter on doc_id reaches the stripes' statistics."""
    return spark.read.schema(SCHEMA).orc(path)


def checksums(stored: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32) counted from the ids themselves: the CRC-32
    of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            raw = memoryview(np.asarray(lists.flatten()).astype("<u4").tobytes())
            ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).tolist()
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "n_tokens", "ids_crc32"],
            )

    return stored.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame) -> DataFrame:
    """Rows of (doc_id, n_tokens, ids_crc32) with ``start``: the ids of all
    documents before, in doc_id order."""
    rows = materialize(rows, "orc_checksums")  # sampled for ranges, then dealt: the ids are read once
    summed = running_total(rows, [], ["doc_id", "n_tokens", "ids_crc32"], "n_tokens", "_run")
    return summed.withColumn("start", F.col("_run") - F.col("n_tokens")).drop("_run")
