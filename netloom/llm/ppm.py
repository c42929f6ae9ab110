"""Language-model scores of documents by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` bytes long with the
counts of what follows each. A symbol (a byte or the end of the text) that a
context has seen gets its share of the counts, less a half each; otherwise an
escape is paid, whose share are these halves (method D), and the next shorter
context predicts, with the symbols that the longer one would have
predicted excluded from its counts. Below the empty context all symbols left
are equally likely. A document's score is the log10 probability of its bytes
and its end; a unigram model of words gives a base score beside it.

Counts are gathered from all training documents. Scoring needs a value for
each distinct word and context of a document: those of the commonest
``COMMON`` are broadcast, and all others are joined with the counts as rows.
What is broadcast changes the work, not the result.

Edge cases: a null text is empty and its score is that of its end; repeated
rows are scored and counted each; with no training documents all symbols are
equally likely and every count is 0; a null doc_id is in training unless the
caller says otherwise; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.llm.units import steps
from netloom.llm.words import scan, text_bytes
from netloom.session import materialize

ORDER = 5
END = 256
SYMBOLS = 257
_BITS = 9
#: Words, and contexts with their symbol, whose values are broadcast, 16 bytes each.
COMMON = 1 << 20
#: Distinct values that a task counts before it hands them on, about 16 bytes each.
HELD = 1 << 20
#: Bytes of text in a step; each takes about 60 bytes of memory for a while.
STEP = 2 << 20
WORD, GRAM = 0, 1


def _mask(symbols: int) -> int:
    return (1 << (_BITS * symbols)) - 1


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ends, keys): for each byte of a text and its end the last ORDER + 1
    symbols, the latest in the lowest bits. Before its start a text has ends."""
    raw, ends = text_bytes(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(ends))
    padded = np.full(len(raw) + n * (ORDER + 1), END, np.int64)
    at = np.arange(len(raw)) + doc * (ORDER + 1) + ORDER
    padded[at] = raw
    keys = padded.copy()
    for j in range(1, ORDER + 1):
        keys[j:] |= padded[:-j] << (_BITS * j)
    real = np.ones(len(padded), bool)
    starts = ends[:-1] + np.arange(n) * (ORDER + 1)
    for j in range(ORDER):
        real[starts + j] = False
    return ends + np.arange(n + 1), keys[real]


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, distinct = pd.factorize(keys)
    return distinct, np.bincount(codes, minlength=len(distinct))


def gather_counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n) over the training rows of ``docs`` (train, text): how
    often each word, by its hash, and each context with its symbol occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WORD: [], GRAM: []}

        def merged(kind: int) -> tuple[np.ndarray, np.ndarray]:
            codes, distinct = pd.factorize(np.concatenate([k for k, _ in held[kind]]))
            return distinct, np.bincount(codes, np.concatenate([n for _, n in held[kind]]), len(distinct)).astype(np.int64)

        def rows(kind: int) -> pa.RecordBatch:
            distinct, n = merged(kind)
            held[kind] = []
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), kind, np.int32)), pa.array(distinct), pa.array(n)], names=["kind", "key", "n"]
            )

        for batch in steps(batches, size=STEP):
            texts = batch.column("text")
            for kind, keys in ((WORD, scan(texts).hashes.view(np.int64)), (GRAM, grams(texts)[1])):
                held[kind].append(_counted(keys))
                if sum(len(k) for k, _ in held[kind]) > HELD:
                    held[kind] = [merged(kind)]
                    if len(held[kind][0][0]) > HELD // 2:
                        yield rows(kind)
        for kind in held:
            if held[kind]:
                yield rows(kind)

    rows = docs.where("train").select("text").mapInArrow(run, "kind int, key long, n long")
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Trie:
    """The tables of the model, by order: counts of (context, symbol), and for
    each context its total, its distinct symbols, and the count that these
    symbols have in the next shorter context."""

    def __init__(self, counts: DataFrame):
        """``counts``: (key, n) of the longest contexts."""
        self.counts: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        for k in range(ORDER, -1, -1):
            longer = counts if k == ORDER else self.counts[k + 1]
            key = F.col("key") if k == ORDER else F.col("key").bitwiseAND(F.lit(_mask(k + 1)))
            self.counts[k] = materialize(longer.groupBy(key.alias("key")).agg(F.sum("n").alias("n")), f"ppm_counts{k}")
        for k in range(ORDER + 1):
            rows = self.counts[k].withColumn("ctx", F.shiftright("key", _BITS))
            if k:
                shorter = self.counts[k - 1].select(F.col("key").alias("_short"), F.col("n").alias("_n"))
                rows = rows.withColumn("_short", F.col("key").bitwiseAND(F.lit(_mask(k)))).join(shorter, "_short")
            else:
                rows = rows.withColumn("_n", F.lit(0))
            table = rows.groupBy("ctx").agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum("_n").alias("below"))
            self.contexts[k] = materialize(table, f"ppm_contexts{k}")

    def log10(self, keys: DataFrame) -> DataFrame:
        """(key, value) for distinct ``keys``, seen in training or not."""
        rows = keys.select("key").withColumns({
            "value": F.lit(0.0), "_open": F.lit(True), "_out": F.lit(0).cast("long"), "_gone": F.lit(0).cast("long"),
        })
        for k in range(ORDER, -1, -1):
            seen = self.counts[k].select(F.col("key").alias("_k"), "n")
            context = self.contexts[k].select(F.col("ctx").alias("_c"), "total", "distinct", "below")
            rows = rows.withColumn("_k", F.col("key").bitwiseAND(F.lit(_mask(k + 1)))).join(seen, "_k", "left")
            rows = rows.withColumn("_c", F.shiftright("_k", _BITS)).join(context, "_c", "left")
            new = F.col("distinct") - F.col("_gone")  # symbols that no longer context has excluded
            all_ = 2 * (F.col("total") - F.col("_out"))
            here = F.col("_open") & F.col("total").isNotNull()
            # without new symbols the escape is certain
            share = F.when(F.col("n").isNotNull(), (2 * F.col("n") - 1) / all_).when(new > 0, new / all_).otherwise(F.lit(1.0))
            rows = rows.select(
                "key",
                (F.col("value") + F.when(here, F.log10(share)).otherwise(F.lit(0.0))).alias("value"),
                (F.col("_open") & ~(here & F.col("n").isNotNull())).alias("_open"),
                F.coalesce("below", F.lit(0).cast("long")).alias("_out"),
                F.coalesce("distinct", F.lit(0).cast("long")).alias("_gone"),
            )
        left = F.log10(F.lit(1.0) / (F.lit(SYMBOLS) - F.col("_gone")))
        # all 257 symbols seen and none open leaves nothing to divide
        return rows.select("key", F.when(F.col("_open"), F.col("value") + left).otherwise(F.col("value")).alias("value"))


def _commonest(counts: DataFrame, most: int) -> DataFrame:
    """Rows with the greatest ``n``, at most ``most`` of each kind, whole
    powers of two of ``n`` at a time."""
    levels = counts.groupBy("kind", F.floor(F.log2("n")).alias("level")).count().collect()  # 64 levels at most
    keep = []
    for kind in (WORD, GRAM):
        kept, least = 0, 64
        for level, n in sorted(((r["level"], r["count"]) for r in levels if r["kind"] == kind), reverse=True):
            if kept + n > most:
                break
            kept, least = kept + n, level
        keep.append((F.col("kind") == kind) & (F.col("n") >= F.lit(float(2**least))))
    return counts.where(reduce(lambda a, b: a | b, keep))


def _lookup(values: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(keys, values) in order of key; at most ``most`` rows of two numbers come
    to the driver, as Arrow columns."""
    table = values.select("key", "value").toArrow()
    keys, found = table["key"].to_numpy().astype(np.int64), table["value"].to_numpy().astype(float)
    order = np.argsort(keys)
    return keys[order], found[order]


def _sums(docs: DataFrame, common: dict[int, DataFrame]) -> DataFrame:
    """One row of kind -1 for each document, with what the common values give:
    its words, those of them that are known, sums of log10(count + 1) and of
    the model; and rows (row, kind, key, n) for the document's other values."""
    tables = {kind: _lookup(values) for kind, values in common.items()}
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        known = shared.value
        for batch in steps(batches, size=STEP):
            texts, n = batch.column("text"), batch.num_rows
            words = scan(texts)
            gram_ends, gram_keys = grams(texts)
            rows = row + np.arange(n)
            row += n
            sums, hits = {}, {}
            for kind, ends, keys in ((WORD, words.ends, words.hashes.view(np.int64)), (GRAM, gram_ends, gram_keys)):
                doc = np.repeat(np.arange(n), np.diff(ends))
                codes, distinct = pd.factorize(keys)
                at = np.minimum(np.searchsorted(known[kind][0], distinct), max(len(known[kind][0]) - 1, 0))
                there = known[kind][0][at] == distinct if len(known[kind][0]) else np.zeros(len(distinct), bool)
                value = np.where(there, known[kind][1][at], 0.0) if len(known[kind][0]) else np.zeros(len(distinct))
                if kind == WORD:
                    value = np.log10(value + 1)
                sums[kind] = np.bincount(doc, value[codes], minlength=n)
                hits[kind] = np.bincount(doc, there[codes], minlength=n)
                others = ~there[codes]
                rest = pd.DataFrame({"d": doc[others], "k": keys[others]}).value_counts(sort=False).reset_index()
                m = len(rest)
                yield _row_batch(rows[rest["d"].to_numpy(np.int64)], np.full(m, kind), rest["k"].to_numpy(np.int64), rest["count"].to_numpy(np.int64), m)
            yield _row_batch(
                rows, np.full(n, -1), np.zeros(n, np.int64), np.diff(words.ends), n,
                batch.column("doc_id").cast(pa.int64()), batch.column("train"), hits[WORD].astype(np.int64), sums[WORD], sums[GRAM],
            )

    return docs.select("doc_id", "train", "text").mapInArrow(
        run, "kind int, row long, key long, n long, doc_id long, train boolean, known long, words double, model double"
    )


def _row_batch(rows, kind, keys, n, m, doc_id=None, train=None, known=None, words=None, model=None) -> pa.RecordBatch:
    def column(values, to):
        return pa.nulls(m, to) if values is None else values if isinstance(values, pa.Array) else pa.array(values, to)

    return pa.RecordBatch.from_arrays(
        [
            pa.array(kind.astype(np.int32)), pa.array(rows.astype(np.int64)), pa.array(keys), pa.array(n.astype(np.int64)),
            column(doc_id, pa.int64()), column(train, pa.bool_()), column(known, pa.int64()), column(words, pa.float64()), column(model, pa.float64()),
        ],
        names=["kind", "row", "key", "n", "doc_id", "train", "known", "words", "model"],
    )


def score(docs: DataFrame, train: Column, most: int = COMMON) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) of
    every document; ``train`` says from which to learn."""
    docs = docs.select("doc_id", "text", F.coalesce(train, F.lit(True)).alias("train"))
    counts = materialize(gather_counts(docs), "ppm_counts", partition_by=["kind"])
    trie = Trie(counts.where(F.col("kind") == GRAM).select("key", "n"))
    learned = docs.where("train").count()
    total, distinct = counts.where(F.col("kind") == WORD).agg(F.sum("n"), F.count("*")).first()
    n_all, n_distinct = (total or 0) + learned, distinct + (1 if learned else 0)
    common = _commonest(counts, most)
    grams_ = trie.log10(common.where(F.col("kind") == GRAM))
    words_ = common.where(F.col("kind") == WORD).select("key", F.col("n").cast("double").alias("value"))
    sums = materialize(_sums(docs, {WORD: words_, GRAM: grams_}), "ppm_sums", partition_by=["kind"])

    def rest(kind: int) -> DataFrame:
        return sums.where(F.col("kind") == kind).select("row", "key", "n")

    seen = counts.where(F.col("kind") == WORD).select("key", F.col("n").alias("c"))
    more_words = rest(WORD).join(seen, "key").select(
        "row", (F.col("n") * F.log10(F.col("c") + 1)).alias("words"), F.col("n").alias("known"), F.lit(0.0).alias("model")
    )
    rare = materialize(trie.log10(rest(GRAM).select("key").distinct()), "ppm_rare")
    more_grams = rest(GRAM).join(rare, "key").select(
        "row", F.lit(0.0).alias("words"), F.lit(0).cast("long").alias("known"), (F.col("n") * F.col("value")).alias("model")
    )
    more = more_words.union(more_grams).groupBy("row").agg(
        F.sum("words").alias("_words"), F.sum("known").alias("_known"), F.sum("model").alias("_model")
    )
    rows = sums.where("kind = -1").join(more, "row", "left")

    def both(a: str) -> Column:
        return F.col(a) + F.coalesce(F.col(f"_{a}"), F.lit(0))

    tokens = F.col("n") + 1
    denominator = float(np.log10(n_all + n_distinct + 1))
    return rows.select(
        "doc_id", "train", tokens.alias("n_tokens"),
        (both("known") + F.lit(1 if learned else 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (both("words") + F.lit(float(np.log10(learned + 1))) - tokens * F.lit(denominator)).alias("base_score"),
        both("model").alias("score"),
    )
