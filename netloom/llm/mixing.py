"""Mixing sources to target weights.

Every document gets a hash-random key; documents are range-sorted by
(source, key), a distributed prefix sum of their sizes is taken within each
source, and the prefix is cut at the source's exact budget. A budget beyond
the source's size repeats whole epochs first.

Edge cases: a null text has size 0; a null source is a source of its own and
comes last; a null doc_id hashes like any other value; repeated rows are
separate documents; an empty table gives an empty result. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netloom.functions.columns import join_null_safe
from netloom.functions.prefix import running_total
from netloom.session import materialize

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The weights that sources take in turn.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, share: float = 1.0, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size).

    ``share`` of the total size is split by weight; weights go to the sources
    in code point order, in turn. A target stops at ``max_epochs`` times its
    source's size and its excess is shared again by weight among the others,
    until none is above. Each round moves two numbers to the driver.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(
        by_source.select("source", "source_size", F.col("source").isNull().cast("int").alias("_last"), F.lit(1).alias("_one")),
        [], ["_last", "source"], "_one", "_rank",
    )
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = materialize(
        ranked.select(
            "source", "source_size",
            F.get(turn, ((F.col("_rank") - 1) % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * max_epochs).alias("_cap"),
        ),
        "mix_sources",
    )
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (total or 0)
    rate, capped = 0.0, -1
    while True:
        # words per unit of weight among the sources that are not at their cap
        at_cap = F.lit(rate) * F.col("weight") > F.col("_cap")
        n, held, free = ranked.agg(
            F.count_if(at_cap), F.sum(F.when(at_cap, F.col("_cap"))), F.sum(F.when(~at_cap, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        capped, rate = n, (total - (held or 0)) / free
    target = F.least(F.lit(float(rate)) * F.col("weight"), F.col("_cap").cast("double"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame, share: float = 1.0, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17
) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words that the mix
    takes of each document, repeats counted.

    A source's budget is its target, rounded down; its whole epochs take every
    document, the rest takes documents in key order and cuts the last of them
    at the word where the budget is met. Keys depend on ``seed`` and doc_id
    alone, so reruns agree.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size")).withColumn(
        "_key", F.xxhash64("doc_id", F.lit(seed))
    )
    run = materialize(running_total(sized, ["source"], ["_key", "doc_id", "size"], "size", "_run"), "mix_sizes")
    targets = materialize(source_targets(run, share, weights, max_epochs), "mix_targets")
    rows = join_null_safe(run, targets, ["source"])
    budget = F.floor("target")
    # a source without words has no budget to cut
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - (F.col("_run") - F.col("size"))))
    taken = F.col("size") * epochs + part
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of the mix itself: each document as often as it is taken,
    the last time cut after the words that the budget still had.

    ``mixed`` comes from ``mix`` over the same ``docs``. Rows that agree in
    doc_id, source and size are told apart by a running number. A cut text
    ends with its last word; n_chars, if there, is counted anew. Documents of
    which nothing is taken are not in the mix.
    """
    keys = ["doc_id", "source", "_size"]
    number = F.row_number()
    kept = mixed.withColumnsRenamed({"size": "_size", "taken": "_taken"}).select(
        *keys, "_taken", number.over(Window.partitionBy(*keys).orderBy(F.desc("_taken"))).alias("_nth")
    ).where("_taken > 0")
    numbered = docs.withColumn("_size", n_words(F.col("text")))
    numbered = numbered.withColumn("_nth", number.over(Window.partitionBy(*keys).orderBy("text")))
    rows = join_null_safe(numbered, kept, [*keys, "_nth"])
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_taken") / F.col("_size")).cast("int"))))
    words = F.least(F.col("_size"), F.col("_taken") - (F.col("_copy") - 1) * F.col("_size")).cast("int")
    # a text is gap, word, gap, word, ..., gap
    gaps = F.slice(F.split("text", WORD), F.lit(1), words)
    found = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words)
    cut = F.array_join(F.flatten(F.transform(F.arrays_zip(gaps.alias("g"), found.alias("w")), lambda x: F.array(x["g"], x["w"]))), "")
    out = rows.withColumn("text", F.when(words < F.col("_size"), cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
