"""Exact top-k search by inner product.

Vectors are integers. Candidates are dealt into blocks by descending length.
A rotation by the eigenvectors of the candidates' Gram matrix (the right
singular vectors) moves most of every vector's length into its first
coordinates. A query goes through the blocks with a threshold, its k-th best
score so far: by the Cauchy-Schwarz inequality a block whose longest vector is
too short is skipped, and so is a candidate whose partial sum over the first
coordinates, plus the product of the two residual lengths, can't reach it.
Integer inner products of what is left decide.

The queries meet the first block, which sets their thresholds, and then, as
rows, those of the other blocks that the thresholds let through; a task holds
one block and streams queries past it. Queries are replicated by blocks, not
by candidates, and blocks hold ``BLOCK`` vectors at most.

Edge cases: vectors that are null or hold a null or a component that is not
finite take no part; shorter vectors are padded with zeros; an empty vector
scores 0 with all; equal scores go by id, repeated rows are candidates of
their own, and a null id takes no part; an id that several query rows share is asked
once, with the least of their vectors, and none of its rows answers it; with fewer candidates than k, all are
returned; an empty table gives an empty result. Components must stay below
2**20 or so in size for scores to fit their type. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netloom.session import materialize

K = 10
SCALE = 1024
#: Candidates in a block: at 64 dimensions 16 MB as long integers.
BLOCK = 32_768
#: Queries that meet a block at once.
CHUNK = 256
#: Share of the Gram matrix's trace that the first coordinates hold.
HEAD = 0.8


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, norm2): v is floor(scale * x) of each component, as longs."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(x.isNotNull() & F.col("vec_id").isNotNull()).where(~bad)
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    return rows.select("vec_id", v.alias("v")).withColumn("norm2", norm2)


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    lengths = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten())
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def rotation(rows: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """Eigenvectors of the Gram matrix by descending eigenvalue, and how many
    coordinates hold ``HEAD`` of the length. A task sends a dim x dim matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((dim, dim))
        for batch in batches:
            m = _matrix(batch.column("v"), dim).astype(float)
            gram += m.T @ m
        i, j = np.divmod(np.arange(dim * dim), dim)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(gram.ravel())], names=["i", "j", "g"])

    entries = rows.select("v").mapInArrow(run, "i long, j long, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()  # dim * dim rows
    gram = np.zeros((dim, dim))
    gram[entries["i"], entries["j"]] = entries["g"]
    values, basis = np.linalg.eigh(gram)
    order = np.argsort(values)[::-1]
    share = np.cumsum(values[order]) / max(values.sum(), 1e-30)
    return basis[:, order], int(min(np.searchsorted(share, HEAD) + 1, dim))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


class Block:
    """Candidates by descending length, whole and rotated."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, basis: np.ndarray, head: int):
        norm2 = (vectors.astype(float) ** 2).sum(axis=1)
        order = np.lexsort((ids, -norm2))
        self.ids, self.vectors, self.norms = ids[order], vectors[order], np.sqrt(norm2[order])
        rotated = self.vectors.astype(float) @ basis
        self.heads = rotated[:, :head]
        self.rests = np.sqrt(np.maximum(norm2[order] - (self.heads**2).sum(axis=1), 0.0))

    def search(self, qids, queries, floors, basis, head, k) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, candidate ids, scores) of the best of this block that
        reach the query's floor."""
        norms = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
        rotated = queries.astype(float) @ basis
        rests = np.sqrt(np.maximum(norms**2 - (rotated[:, :head] ** 2).sum(axis=1), 0.0))
        for i in range(len(qids)):
            floor = floors[i]
            scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
            at, step = 0, 16 * k
            while at < len(self.ids):
                slack = 1e-9 * (norms[i] * self.norms[at] + 1)
                if norms[i] * self.norms[at] + slack < floor:
                    break  # all that follow are shorter
                to = min(at + step, len(self.ids))
                bound = self.heads[at:to] @ rotated[i, :head] + rests[i] * self.rests[at:to] + slack
                open_ = at + np.flatnonzero((bound >= floor) & (self.ids[at:to] != qids[i]))
                if len(open_):
                    scores = np.concatenate([scores, self.vectors[open_] @ queries[i]])
                    ids = np.concatenate([ids, self.ids[open_]])
                    best = _best(scores, ids, k)
                    scores, ids = scores[best], ids[best]
                    if len(scores) == k:
                        floor = max(floor, float(scores[-1]))
                at, step = to, min(step * 2, 8192)
            yield qids[i], ids, scores


def _pairs(blocks: DataFrame, asked: DataFrame, basis: np.ndarray, head: int, dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each block for each query of
    ``asked`` (block, vec_id, v, floor) that is sent to it."""
    rows = blocks.select("block", F.lit(0).alias("side"), "vec_id", "v", F.lit(0.0).alias("floor")).union(
        asked.select("block", F.lit(1).alias("side"), "vec_id", "v", "floor")
    )
    shared = rows.sparkSession.sparkContext.broadcast((basis, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, first = shared.value
        number, block, parts = None, None, []
        for batch in batches:
            groups, sides = np.asarray(batch.column("block")), np.asarray(batch.column("side"))
            cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(sides) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)]):
                part = batch.slice(a, b - a)
                ids, vectors = np.asarray(part.column("vec_id")), _matrix(part.column("v"), dim)
                if groups[a] != number:
                    number, block, parts = groups[a], None, []
                if sides[a] == 0:
                    parts.append((ids, vectors))
                    continue
                if block is None and parts:
                    block = Block(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]), turn, first)
                    parts = []
                if block is None:
                    continue
                floors = np.asarray(part.column("floor"))
                for at in range(0, len(ids), CHUNK):
                    out = list(block.search(ids[at : at + CHUNK], vectors[at : at + CHUNK], floors[at : at + CHUNK], turn, first, k))
                    sizes = [len(s) for _, _, s in out]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.array([q for q, _, _ in out], np.int64), sizes)),
                            pa.array(np.concatenate([x for _, x, _ in out])),
                            pa.array(np.concatenate([s for _, _, s in out])),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    in_order = rows.repartition("block").sortWithinPartitions("block", "side")
    return in_order.mapInArrow(run, "query_id long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id,
    embedding) that ``is_query`` holds for, its k greatest inner products with
    other rows."""
    rows = materialize(quantized(vectors), "topk_vectors")
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = max(dim or 0, 1)
    basis, head = rotation(rows, dim)
    # blocks by descending length, some for every task; ids part vectors of one length
    count = max(-(-n // block), min(16, -(-n // 1024)), 1)
    dealt = rows.repartitionByRange(count, F.desc("norm2"), F.xxhash64("vec_id")).withColumn("block", F.spark_partition_id())
    dealt = materialize(dealt, "topk_blocks")
    longest = dealt.groupBy("block").agg(F.sqrt(F.max("norm2")).alias("longest"))
    longest = materialize(longest, "topk_lengths")
    asked_once = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "norm2")).alias("q"))
    queries = asked_once.select("vec_id", "q.v", "q.norm2")
    first, last = longest.agg(F.max_by("block", "longest"), F.max("block")).first()
    opening = queries.select(F.lit(first if first is not None else 0).alias("block"), "vec_id", "v", F.lit(-1e300).alias("floor"))
    found = materialize(_top(_pairs(dealt.where(F.col("block") == F.lit(first)), opening, basis, head, dim, k), k), "topk_first")
    floors = found.where(F.col("rank") == k).groupBy("query_id").agg(F.min("score").cast("double").alias("floor"))
    asked = queries.join(floors.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    asked = asked.withColumn("floor", F.coalesce("floor", F.lit(-1e300)))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last or 0)))).join(longest, "block")
    reach = F.sqrt("norm2") * F.col("longest")
    asked = asked.where((F.col("block") != F.lit(first)) & (reach * (1 + 1e-9) + 1 >= F.col("floor")))
    rest = _pairs(dealt.where(F.col("block") != F.lit(first)), asked, basis, head, dim, k)
    return _top(found.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
