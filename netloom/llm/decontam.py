"""Benchmark passages in documents, from built-in functions only.

A window is ``SIZE`` consecutive words of a benchmark item (all words of a
shorter one); a document is contaminated where a window occurs in it, word for
word. This is a set join of windows with documents at containment 1: a window's
shingles (pairs of neighbouring words) are ordered by how rare they are in the
documents, and since all of them must occur, the rarest alone is a necessary
prefix. Only that one is joined. A hit of it fixes where the window would have
to start; windows that would begin before the document or end after it are
dropped by position and length, and the words themselves decide the rest.

Documents are read twice, once to count the benchmark's shingles in all of them
and once to join, and neither their texts nor their words are shuffled: the
benchmark's rows come to them by broadcast, in blocks of at most ``BLOCK`` rows
with a pass over the documents for each, so that what is sent is bounded however
large the benchmark is. What is shuffled is one row for each document and one for
each occurrence of a window, keyed by the document.

Edge cases: a null or wordless text has no words and no windows; a null doc_id is
returned as it is, and rows that share an id are answered each; items that share
an item_id are one item; windows of an item without id are hit but not counted as
an item; empty tables give an empty or a clean result. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.session import materialize

SIZE = 10
#: Rows of benchmark data that one broadcast holds (a window is about 150 bytes).
BLOCK = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII characters that part words, but for the blank.
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum() and c != 32)


def words(text: str | Column) -> Column:
    """The runs of letters, digits and characters beyond ASCII, A-Z in lower case."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    spaced = F.trim(F.translate(text, _BETWEEN + _UPPER, " " * len(_BETWEEN) + _UPPER.lower()))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " +"))


def _shingle(first: Column, second: Column) -> Column:
    """A shingle's key; one word if there is no second. Equal keys of different
    shingles only make a candidate more."""
    return F.xxhash64(first, second)


def windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """(item_id, n, words): every window of every item; ids as text."""
    split = items.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    each = split.select("item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at"))
    return each.select("item_id", "n", F.slice("w", F.col("at"), F.col("n")).alias("words"))


#: The key of the empty window, which every document has once, at its end.
_END = 0


def _positions(docs: DataFrame, single: bool) -> DataFrame:
    """One row for each shingle of a document, (doc_id, text_hash, n_words, w, at, key):
    pairs of words, and single words too if ``single``; and one for its end."""
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words("text").alias("w"))
    pairs = F.arrays_zip(F.col("w").alias("a"), F.slice(F.col("w"), F.lit(2), F.greatest(F.size("w"), F.lit(1))).alias("b"))
    end = F.array(F.struct(F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b")))
    rows = split.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), "w", F.posexplode_outer(F.concat(pairs, end)).alias("at", "s"))
    pair = F.when(F.col("s.a").isNull(), F.lit(_END).cast("long")).otherwise(_shingle(F.col("s.a"), F.col("s.b")))
    kept = ["doc_id", "text_hash", "n_words", "w", "at"]
    if not single:
        return rows.select(*kept, pair.alias("key"))
    one = F.when(F.col("s.b").isNotNull(), F.xxhash64(F.col("s.a")))  # the last word's pair is itself
    return rows.select(*kept, F.explode(F.array(pair, one)).alias("key")).where("key IS NOT NULL")


def _blocks(rows: DataFrame, key: str, block: int) -> list[DataFrame]:
    """``rows`` in parts of about ``block`` rows, by key, each to be broadcast."""
    n = max(1, math.ceil(rows.count() / block))
    return [F.broadcast(rows.where(F.pmod(F.hash(key), F.lit(n)) == i) if n > 1 else rows) for i in range(n)]


def _prefixes(docs: DataFrame, listed: DataFrame, single: bool, block: int) -> DataFrame:
    """(key, offset, window, words, n): each window under its rarest shingle."""
    at = F.posexplode(F.arrays_zip(F.col("words").alias("a"), F.slice("words", F.lit(2), F.size("words")).alias("b"))).alias("offset", "s")
    shingles = listed.select("window", "words", "n", at)
    # the last word's pair is a shingle only of a window of one word
    shingles = shingles.where("n = 1 OR s.b IS NOT NULL").select(
        "window", "words", "n", "offset", _shingle(F.col("s.a"), F.col("s.b")).alias("key")
    )
    known = materialize(shingles.select("key").distinct(), "benchmark_shingles")
    positions = _positions(docs, single).select("key")
    counts = reduce(DataFrame.unionByName, [positions.join(b, "key") for b in _blocks(known, "key", block)]).groupBy("key").count()
    ranked = shingles.join(counts, "key", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "key", "offset")).alias("rarest")
    )
    return listed.join(ranked, "window").select("rarest.key", "rarest.offset", "window", "words", "n")


def occurrences(docs: DataFrame, prefixes: DataFrame, single: bool, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash, n_words, start, n, window): where windows occur; and
    for each document a row of the empty window (n is 0)."""
    empty = F.array().cast("array<string>").alias("words")
    end = docs.sparkSession.range(1).select(
        F.lit(_END).cast("long").alias("key"), F.lit(0).alias("offset"), F.lit(-1).cast("long").alias("window"), empty, F.lit(0).alias("n")
    )
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words")) & ((F.col("n") > 0) | (start == F.col("n_words")))
    same = F.slice(F.col("w"), F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("words")
    blocks = _blocks(materialize(prefixes.unionByName(end), "benchmark_prefixes"), "key", block)
    hits = [_positions(docs, single).join(b, "key").where(fits & same) for b in blocks]
    return reduce(DataFrame.unionByName, [h.select("doc_id", "text_hash", "n_words", start.alias("start"), "n", "window") for h in hits])


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) of every document:
    words, words inside an occurrence of a window, and the ids, as text and in
    order, of the items whose windows occur."""
    docs = docs.select("doc_id", "text")
    each = materialize(windows(items.select("item_id", "text"), size), "benchmark_windows")
    listed = each.select("words", "n").distinct().select(F.monotonically_increasing_id().alias("window"), "words", "n")
    listed = materialize(listed, "benchmark_listed")
    owners = each.where("item_id IS NOT NULL").join(listed, ["words", "n"]).select("window", "item_id").distinct()
    single = not listed.where("n = 1").isEmpty()
    found = occurrences(docs, _prefixes(docs, listed, single, block), single, block)
    key = ["doc_id", "text_hash"]
    per_doc = found.groupBy(*key).agg(
        F.first("n_words").alias("n_words"), F.count_if(F.col("n") == 0).alias("rows"),
        F.collect_set(F.when(F.col("n") > 0, F.struct("start", "n"))).alias("spans"),
        F.collect_set(F.when(F.col("n") > 0, F.col("window"))).alias("windows"),
    )
    per_doc = materialize(per_doc, "benchmark_hits")
    # words under the spans, in order of start: those beyond the furthest end so far
    begin = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate(
        F.array_sort("spans"), begin,
        lambda acc, s: F.struct(
            (acc["hit"] + F.greatest(s["start"] + s["n"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("hit"),
            F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
        ),
        lambda acc: acc["hit"],
    )
    clashes = per_doc.where(F.size("windows") > 0).select(*key, F.explode("windows").alias("window")).join(owners, "window")
    by_doc = clashes.groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    by_doc = by_doc.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "items")
    rows = per_doc.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    none = F.array().cast("array<string>")
    rows = rows.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.coalesce("items", none).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_row"),
    )
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated")
    )
