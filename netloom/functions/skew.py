"""Joins in which a few keys hold many of the rows, or most rows find no partner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds more than one in ``SHARE`` of the rows, so there
#: are fewer than ``SHARE`` heavy keys, however many rows there are.
SHARE = 1_000


def heavy_keys(df: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """(key, _salts): the heavy keys of ``df``, fewer than ``share``, and into how
    many parts each has to be dealt for a part to hold one in ``share`` of the rows."""
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.where(F.col("_n") * F.lit(share) > total)
    return heavy.select(key, F.ceil(F.col("_n") * F.lit(share) / total).cast("int").alias("_salts"))


def salted_join(big: DataFrame, small: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """``big`` joined to ``small`` on ``key``; ``heavy`` is from ``heavy_keys(big, key)``.

    A heavy key's rows of ``big`` are dealt over its parts by their other
    columns, and its rows of ``small`` are repeated for each part: at most
    twice ``share`` repeats in all where ``small`` holds a key once."""
    h = F.broadcast(heavy)
    others = [c for c in big.columns if c != key]
    part = F.pmod(F.xxhash64(*others), F.col("_salts")).cast("int")
    dealt = big.join(h, key, "left").select(*big.columns, F.coalesce(part, F.lit(0)).alias("_part"))
    repeated = small.join(h, key, "left").select(
        *small.columns, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)).alias("_part")
    )
    return dealt.join(repeated, [key, "_part"]).drop("_part")


def sieve(big: DataFrame, key: str, small: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """``big`` without most of the rows whose ``key`` is not in ``small``, before
    a join that drops the rest. No row with a partner is dropped.

    Hashes of ``small``'s keys are marked in words of 64 bits, at most ``bits``
    in all, which are broadcast. Where ``small`` has too many keys for that,
    ``big`` stays as it is. ``small`` is read twice."""
    n = small.count()
    if n > bits // 4:
        return big
    size = min(bits, max(16 * n, 64))
    at = F.pmod(F.xxhash64(key), F.lit(size))
    bit = F.expr("shiftleft(1L, cast(_at % 64 AS int))")
    words = small.select(at.alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = big.withColumn("_at", at).withColumn("_word", F.shiftright("_at", 6)).join(F.broadcast(words), "_word")
    return marked.where(F.col("_bits").bitwiseAND(bit) != 0).select(*big.columns)
