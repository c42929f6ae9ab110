"""Exact self-join of documents by Jaccard similarity of word shingles.

Documents with the same shingle set are one class and are joined once. A class
is indexed under the shingles of its prefix: rare ones come first, and two
sets that are similar enough share one there. Three steps skip what the lists
of the index would otherwise repeat:

* Lists are cut into blocks by set size, and an entry's position bounds the
  overlap that its pair can still reach, so blocks and entries that can't make
  the similarity are not paired.
* Every list has a few hubs. Its sets are compared with the hubs first, and
  the overlaps are kept as the sets' answers. Sets linked to a hub are in its
  component, and pairs within a component are never formed: only components
  are asked for.
* A pair across components first gets bounds from the two sets' answers for a
  hub that they share: |y & z| is at least |x & y| + |x & z| - |x|, and at most
  min(|x & y|, |x & z|) + min(|y - x|, |z - x|). Only pairs that the bounds
  leave open are compared as sets.

All candidate pairs across components are settled, so the components are
exact, up to collisions of 64-bit hashes.

Edge cases: a null or blank text has no shingles and is linked with nothing;
rows that share a doc_id are documents of their own, whose component takes the
smallest doc_id; a null doc_id is a component's id only if all of its
documents have none; an empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from netloom.llm.graph import components
from netloom.llm.units import steps
from netloom.llm.words import _mix, shingle_sets
from netloom.session import materialize

SIZE = 5
#: Similarity of 75 in 100; overlaps are compared in whole numbers.
NEAR, OF = 75, 100
#: Shingles that may be marked as common; they are broadcast, 9 bytes each.
#: Which ones are marked changes the work, never the result.
COMMON = 1 << 20
#: A shingle is counted as common in a step (some thousand documents) if so many have it.
LOCAL = 3
HUBS = 2
#: Hubs that a set may meet in the round after that.
CENTRAL = 8
#: Ids of the documents whose texts are read again that are broadcast; more of
#: them are joined.
SENT = 1 << 20
#: Sets that a bucket of pairs holds.
BUCKET = 2048
_SIGN = np.uint64(0x8CB92BA72F3D8DD7)


def _signatures(ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One hash for each set, independent of order; 0 for empty sets."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes ^ _SIGN))])
    sizes = np.diff(ends).astype(np.uint64)
    signed = _mix(sums[ends[1:]] - sums[ends[:-1]] + sizes * _SIGN)
    return np.where(sizes > 0, signed, np.uint64(0)).view(np.int64)


def survey(docs: DataFrame) -> DataFrame:
    """Rows of kind 0: (doc_id, set size, class); and of kind 1: a shingle that
    several texts of one step share, and in how many. Whole texts are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            ends, hashes = shingle_sets(batch.column("text"), SIZE)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(ends)), pa.array(_signatures(ends, hashes))],
                names=["kind", "a", "b", "c"],
            )
            ordered = np.sort(hashes)
            starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
            counts = np.diff(np.concatenate([starts, [len(ordered)]]))
            many = counts >= LOCAL
            m = int(many.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.array(ordered[starts[many]].view(np.int64)), pa.array(counts[many].astype(np.int64)), pa.array(np.zeros(m, np.int64))],
                names=["kind", "a", "b", "c"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "kind int, a long, b long, c long")


def common_shingles(counted: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles, at most ``most``, in order of hash, and a level
    (log2 of their count) for each. Counts cover all documents."""
    totals = counted.groupBy("a").agg(F.sum("b").alias("n")).withColumn("level", F.floor(F.log2("n")).cast("int"))
    totals = materialize(totals.select("a", "level"), "jaccard_common")
    at_least, kept = 64, 0
    for level, n in sorted(totals.groupBy("level").count().collect(), reverse=True):  # 63 levels at most
        if kept + n > most:
            break
        at_least, kept = level, kept + n
    rows = totals.where(F.col("level") >= at_least).toArrow()
    tokens = rows["a"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["level"].to_numpy().astype(np.int64)[order]


def prefix_entries(docs: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, s, n, pos): the index entries of each class ``s``, its prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, levels = shared.value
        for batch in steps(batches):
            ends, hashes = shingle_sets(batch.column("text"), SIZE)
            # a set that comes again within the step has given its entries already
            signs = _signatures(ends, hashes)
            first = np.zeros(len(signs), bool)
            first[np.unique(signs, return_index=True)[1]] = True
            sizes = np.diff(ends)
            level = np.zeros(len(hashes), np.int64)
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                level = np.where(tokens[at] == hashes, levels[at], 0)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(owner << 6 | level, kind="stable")
            pos = np.arange(len(hashes)) - ends[owner]
            length = sizes - -(-sizes * NEAR // OF) + 1
            keep = first[owner] & (pos < length[owner])
            owner = owner[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[order[keep]].view(np.int64)),
                    pa.array(signs[owner]),
                    pa.array(sizes[owner].astype(np.int32)),
                    pa.array(pos[keep].astype(np.int32)),
                ],
                names=["token", "s", "n", "pos"],
            )

    return docs.select("text").mapInArrow(run, "token long, s long, n int, pos int")


def _doc() -> Column:
    """doc_id as a join key; a null one joins as the least number."""
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("_doc")


def _need(n: Column, m: Column) -> Column:
    """The overlap that sets of these sizes need."""
    return F.ceil((F.lit(NEAR) * (n + m).cast("long")) / F.lit(float(NEAR + OF)))


def _band(n: Column) -> Column:
    """Sizes whose sets can be similar are at most one band apart."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(OF / NEAR)) + F.lit(1e-9)).cast("int")


def _unpacked(raw: bytes, heads: bool = False) -> np.ndarray:
    """A set's hashes, which travel in order, whole or as their first 16 bits.
    Equal heads are told apart by their number."""
    if not heads:
        return np.frombuffer(raw, np.uint64)
    found = np.frombuffer(raw, np.uint16)
    number = np.arange(len(found)) - np.searchsorted(found, found)
    return found.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)


def _sets_of(classes_in_question: DataFrame, docs: DataFrame, classes: DataFrame, heads: bool = False) -> DataFrame:
    """(s, set) of the classes, from one text of each; other texts stay where they are."""
    needed = materialize(classes_in_question.join(classes, "s").select("_doc").distinct(), "jaccard_needed")
    if needed.count() <= SENT:
        needed = F.broadcast(needed)
    texts = docs.select(_doc(), "text").join(needed, "_doc", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            ends, hashes = shingle_sets(batch.column("text"), SIZE)
            sent = (hashes >> np.uint64(48)).astype(np.uint16) if heads else hashes
            sets = [sent[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(_signatures(ends, hashes)), pa.array(sets, pa.binary())], names=["s", "set"])

    return texts.mapInArrow(run, "s long, set binary")


def overlaps(pairs: DataFrame, docs: DataFrame, classes: DataFrame, heads: bool = False) -> DataFrame:
    """``pairs`` (x, y, n, m, near) with the number of shingles that both have.
    With ``heads`` a quarter of the bytes move, and the number is of equal heads
    of their hashes: at least that of the shingles.

    Pairs with the same ``near`` are likely to share sets, so they are dealt
    into buckets by it, with at most about ``BUCKET`` sets of either side, and
    a set goes to a bucket once, not once for each pair. A task holds a bucket's
    sets x and streams the sets y past them.
    """
    pairs = materialize(pairs, "jaccard_pairs")
    sets = _sets_of(pairs.select(F.col("x").alias("s")).union(pairs.select("y")).distinct(), docs, classes, heads)
    sizes = pairs.groupBy("near").agg(
        F.ceil(F.approx_count_distinct("x") / BUCKET).alias("_xs"), F.ceil(F.approx_count_distinct("y") / BUCKET).alias("_ys")
    )
    # only values of near with more sets than a bucket holds are cut: few, and broadcast,
    # so the pairs of a frequent one stay where they are
    large = F.broadcast(sizes.where("_xs > 1 OR _ys > 1"))
    part = [F.coalesce(F.pmod(F.xxhash64(c), n), F.lit(0).cast("long")) for c, n in (("x", "_xs"), ("y", "_ys"))]
    dealt = pairs.join(large, "near", "left").select(F.xxhash64("near", *part).alias("b"), "x", "y", "n", "m")
    partners = "array<struct<x:bigint,n:int,m:int>>"
    xs = dealt.select("b", F.col("x").alias("s")).distinct().withColumn("partners", F.lit(None).cast(partners))
    ys = dealt.groupBy("b", F.col("y").alias("s")).agg(F.collect_list(F.struct("x", "n", "m")).alias("partners"))
    rows = xs.unionByName(ys).join(sets, "s").withColumn("side", F.col("partners").isNotNull().cast("int"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, {}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["b"] != bucket:
                    bucket, held = r["b"], {}
                if r["side"] == 0:
                    held[r["s"]] = _unpacked(r["set"], heads)
                    continue
                own = _unpacked(r["set"], heads)
                for p in r["partners"]:
                    few, many = sorted((own, held[p["x"]]), key=len)
                    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                    out.append((p["x"], r["s"], p["n"], p["m"], int((many[at] == few).sum())))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["x", "y", "n", "m", "overlap"])

    in_order = rows.select("b", "side", "s", "partners", "set").repartition("b").sortWithinPartitions("b", "side")
    # a set is there twice if two rows share its text and doc_id
    return in_order.mapInArrow(compare, "x long, y long, n int, m int, overlap int").distinct()


def _edges(comps: DataFrame) -> DataFrame:
    return comps.select(F.col("v").alias("a"), F.col("c").alias("b"))


def settle(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` with a bound of their overlap, and the overlaps of those that
    the bound lets be similar; whole sets move for these alone."""
    bounded = materialize(overlaps(pairs, docs, classes, heads=True), "jaccard_bounded")
    similar = bounded.where(F.col("overlap") >= _need(F.col("n"), F.col("m")))
    exact = overlaps(similar.select("x", "y", "n", "m", F.col("x").alias("near")), docs, classes)
    return bounded, materialize(exact, "jaccard_compared")


def _links(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("overlap") >= _need(F.col("n"), F.col("m"))).select(F.col("x").alias("a"), F.col("y").alias("b"))


def hub_pairs(entries: DataFrame) -> DataFrame:
    """(x, y, n, m, near): each set y of a list with the list's hubs x. The hubs
    are the sets with the least hashes, so lists that share sets share hubs;
    ``near`` is the first of y's hubs."""
    picks = [F.min(F.struct(F.xxhash64("s", F.lit(k)), "s", "n", "pos")).alias(f"h{k}") for k in range(HUBS)]
    hubs = entries.groupBy("token").agg(*picks).select("token", F.array_distinct(F.array(*[f"h{k}" for k in range(HUBS)])).alias("hubs"))
    rows = entries.join(hubs, "token").select("s", "n", "pos", F.explode("hubs").alias("hub"))
    x, y, n, m = F.col("hub.s"), F.col("s"), F.col("hub.n"), F.col("n")
    reach = F.least(n - F.col("hub.pos"), m - F.col("pos")) >= _need(n, m)
    return rows.where((x != y) & reach).select(x.alias("x"), y.alias("y"), n.alias("n"), m.alias("m")).distinct().withColumn(
        "near", F.min_by("x", F.xxhash64("x", F.lit(0))).over(Window.partitionBy("y"))
    )


def open_lists(entries: DataFrame, comps: DataFrame) -> DataFrame:
    """(token, s, n, pos, c, _first) of the lists with sets of several components;
    ``_first`` is that of the list's first hub. A list of two sets has had its
    only pair compared."""
    marked = entries.join(comps.select(F.col("v").alias("s"), "c"), "s", "left").withColumn("c", F.coalesce("c", "s"))
    firsts = marked.groupBy("token").agg(
        F.min(F.struct(F.xxhash64("s", F.lit(0)), "c"))["c"].alias("_first"), F.min("c").alias("_low"), F.max("c").alias("_high"),
        F.count(F.lit(1)).alias("_sets"),
    )
    marked = marked.join(firsts.where("_low < _high AND _sets > 2"), "token")
    return materialize(marked.select("token", "s", "n", "pos", "c", "_first"), "jaccard_lists")


def central_pairs(lists: DataFrame, hubs: int = CENTRAL) -> DataFrame:
    """(x, y, n, m, near): sets y with up to ``hubs`` sets x of another component,
    those that stand earliest in a list: they have the fewest rare shingles, so
    they are near the middle of a group of near copies. A set meets the hubs of
    one list for each first component, as lists of one group have the same hubs."""
    slot = F.pmod(F.xxhash64("s", F.lit(hubs)), F.lit(hubs))
    picks = lists.groupBy("token", slot.alias("slot")).agg(F.min(F.struct("pos", F.xxhash64("s"), "s", "n", "c")).alias("hub"))
    rows = lists.groupBy("s", "n", "c", "_first").agg(F.min(F.struct("pos", "token")).alias("at"))
    met = rows.select("s", "n", "c", "at.pos", "at.token").join(picks, "token")
    x, y, n, m = F.col("hub.s"), F.col("s"), F.col("hub.n"), F.col("n")
    reach = F.least(n - F.col("hub.pos"), m - F.col("pos")) >= _need(n, m)
    met = met.where((F.col("c") != F.col("hub.c")) & reach)
    return met.select(x.alias("x"), y.alias("y"), n.alias("n"), m.alias("m"), F.col("hub.c").alias("near")).distinct()


def fresh(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """``pairs`` that are not among ``compared``, in either order."""
    done = compared.select(F.least("x", "y").alias("_a"), F.greatest("x", "y").alias("_b"))
    met = pairs.withColumns({"_a": F.least("x", "y"), "_b": F.greatest("x", "y")})
    return met.join(done, ["_a", "_b"], "left_anti").dropDuplicates(["_a", "_b"]).select(*pairs.columns)


def cross_pairs(marked: DataFrame) -> DataFrame:
    """(x, y, n, m, near): the candidate pairs of ``open_lists`` whose sets are in
    different components; ``near`` is that of y.

    In each list the sets of the first hub's component need no pairs among
    themselves; the others are joined with the list, block by block.
    """
    marked = marked.withColumn("band", _band(F.col("n")))
    few = marked.where("c <> _first").select(
        "token", F.col("s").alias("x"), F.col("n").alias("n"), F.col("pos").alias("i"), F.col("c").alias("_c"),
        F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
    )
    lists = marked.select(
        F.col("token").alias("t"), F.col("s").alias("y"), F.col("n").alias("m"), F.col("pos").alias("j"), "c",
        F.col("band").alias("_band"), (F.col("c") != F.col("_first")).alias("_few"),
    )
    reach = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) >= _need(F.col("n"), F.col("m"))
    once = ~F.col("_few") | (F.col("x") < F.col("y"))  # pairs of two such sets come from both sides
    met = few.join(
        lists, (F.col("token") == F.col("t")) & (F.col("band") == F.col("_band")) & (F.col("_c") != F.col("c")) & reach & once
    )
    return met.select("x", "y", "n", "m", F.col("c").alias("near")).distinct()


def derive(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """``pairs`` with ``low`` and ``high``, bounds of their overlap from the
    answers for the hubs that both sets were compared with."""
    answers = compared.select(F.col("y").alias("s"), F.struct(F.col("x").alias("hub"), F.col("n").alias("size"), "overlap").alias("answer"))
    answers = answers.groupBy("s").agg(F.collect_list("answer").alias("answers"))
    rows = pairs.join(answers.select(F.col("s").alias("x"), F.col("answers").alias("_a")), "x", "left")
    rows = rows.join(answers.select(F.col("s").alias("y"), F.col("answers").alias("_b")), "y", "left")

    def bounds(p: Column) -> Column:
        match = F.filter("_b", lambda q: q["hub"] == p["hub"])
        return F.transform(match, lambda q: F.struct(
            (p["overlap"] + q["overlap"] - p["size"]).alias("low"),
            (F.least(p["overlap"], q["overlap"]) + F.least(F.col("n") - p["overlap"], F.col("m") - q["overlap"])).alias("high"),
        ))

    both = F.flatten(F.transform("_a", bounds))
    rows = rows.withColumn("_bounds", F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), both))
    low = F.coalesce(F.array_max(F.transform("_bounds", lambda t: t["low"])), F.lit(0))
    high = F.coalesce(F.array_min(F.transform("_bounds", lambda t: t["high"])), F.least("n", "m"))
    return rows.select("x", "y", "n", "m", "near", low.alias("low"), high.alias("high"))


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s, c) of every document: set size, class, and the least class
    of its component."""
    surveyed = materialize(survey(docs), "jaccard_survey", partition_by=["kind"])
    rows = surveyed.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n"), F.col("c").alias("s"))
    common = common_shingles(surveyed.where("kind = 1").select("a", "b"))
    # a document for each class, to read its text again
    classes = rows.where("n > 0").groupBy("s").agg(F.min(_doc()).alias("_doc"))
    # lists of one class have nothing to pair; the others are few
    of_token = Window.partitionBy("token")
    entries = prefix_entries(docs, common).select(
        "*", F.min("s").over(of_token).alias("_low"), F.max("s").over(of_token).alias("_high")
    )
    entries = entries.where("_low < _high").select("token", "s", "n", "pos").distinct()
    entries = materialize(entries, "jaccard_entries")
    asked, compared = settle(hub_pairs(entries), docs, classes)
    comps = components(_links(compared))
    lists = open_lists(entries, comps)
    bounded, more = settle(fresh(central_pairs(lists), asked), docs, classes)
    asked, compared = asked.union(bounded), compared.union(more)
    comps = components(_edges(comps).union(_links(more)))
    lists = open_lists(lists.select("token", "s", "n", "pos"), comps)
    pairs = materialize(derive(fresh(cross_pairs(lists), asked), compared), "jaccard_cross")
    need = _need(F.col("n"), F.col("m"))
    derived = pairs.where(F.col("low") >= need).select(F.col("x").alias("a"), F.col("y").alias("b"))
    left = pairs.where((F.col("low") < need) & (F.col("high") >= need)).select("x", "y", "n", "m", "near")
    late = _links(settle(left, docs, classes)[1])
    comps = components(_edges(comps).union(derived).union(late))
    rows = rows.join(comps.select(F.col("v").alias("s"), "c"), "s", "left").withColumn("c", F.coalesce("c", "s"))
    return materialize(rows, "jaccard_rows")


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class, component_id) of every document."""
    rows = _rows(docs)
    ids = rows.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    rows = rows.join(ids, "c", "left")
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("s").alias("class"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _with_class(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``_class``: the signature of its shingles, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            classes = pa.array(_signatures(*shingle_sets(batch.column("text"), SIZE)))
            yield pa.RecordBatch.from_arrays([*batch.columns, classes], names=[*batch.schema.names, "_class"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("_class", LongType())]))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id (a null
    one comes last), then the least class, then the least hash of its text.
    Documents without shingles stay, those equal in doc_id and text as one row."""
    rows = _rows(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "s"))
    best = rows.where("n > 0").groupBy("c").agg(least.alias("k")).select("k.doc_id", "k.s")
    blank = rows.where("n = 0").select("doc_id", "s").distinct()
    kept = materialize(best.union(blank).select(_doc(), F.col("s").alias("_class")), "jaccard_kept")
    ids = kept.select("_doc").distinct()
    if kept.count() <= SENT:
        ids = F.broadcast(ids)
    found = docs.select("*", _doc()).join(ids, "_doc", "left_semi")
    # ids that several rows share name no row; their classes tell which to take
    shared = rows.select(_doc()).groupBy("_doc").agg(F.count("*").alias("n")).where("n > 1").select("_doc")
    shared = materialize(shared.join(ids, "_doc", "left_semi"), "jaccard_shared")
    if shared.isEmpty():
        return found.select(*docs.columns)
    alone = found.join(shared, "_doc", "left_anti").select(*docs.columns)
    several = _with_class(found.join(shared, "_doc", "left_semi")).join(kept, ["_doc", "_class"], "left_semi")
    several = materialize(several.withColumn("_text", F.xxhash64("text")), "jaccard_several")
    of_class = several.where("_class <> 0").groupBy("_doc", "_class").agg(F.min("_text").alias("_text"))
    first = several.join(of_class, ["_doc", "_class", "_text"], "left_semi").unionByName(several.where("_class = 0"))
    return alone.union(first.dropDuplicates(["_doc", "_class", "_text"]).select(*docs.columns))
