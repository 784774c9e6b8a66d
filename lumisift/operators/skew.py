"""Joins that stay spread out when one key holds a large part of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with at least so many rows, and a thousandth of all, is hot and never meets one task.
HOT_ROWS = 1_000_000
#: A hot key's rows are dealt out in parts of a threshold over this.
PARTS = 16
#: Parts over which null keys are dealt out; they have no partner.
NULL_PARTS = 4096


def hot_threshold(total: int, least: int | None = None) -> int:
    """Rows from which a key is hot. At most 1,000 keys can reach a thousandth of ``total``."""
    return max(HOT_ROWS if least is None else least, -(-total // 1000), 1)


def skew_join(big: DataFrame, dim: DataFrame, keys: list[str], rows: str, threshold: int, spread: Column, how: str = "left", total: int | None = None) -> DataFrame:
    """Join ``dim`` (one row per key, ``rows`` = rows of ``big`` with that key, not negative) to ``big``.

    A hot key's rows are dealt out by ``spread`` over parts of a 16th of ``threshold``, and its dim row is repeated for each part: both sides are
    shuffled by key and part, so that no task receives a whole hot key. Under :func:`hot_threshold` there are at most 1,000 hot keys, which alone are
    broadcast (without the dim's other columns), and at most 17,000 repeated dim rows. Null keys have no partner and are
    dealt out too. ``how`` is ``left``, ``inner`` or ``left_semi``. Where ``total``, the rows of ``big``, is given and below the threshold, no key can be
    hot and this is a plain join.
    """
    if total is not None and total < threshold:
        return _columns(big.join(dim.drop(rows), keys, how), big, dim.drop(rows), keys, how)
    parts = F.when(F.col(rows) >= threshold, F.ceil(F.col(rows) * PARTS / threshold).cast("bigint"))
    sized = dim.withColumn("__parts", parts).drop(rows)
    return _salted(big, sized, F.broadcast(sized.filter("__parts is not null").select(*keys, "__parts")), keys, spread, how)


def spread_join(big: DataFrame, dim: DataFrame, keys: list[str], spread: Column, total: int, how: str = "left", least: int | None = None) -> DataFrame:
    """:func:`skew_join` for a ``dim`` (at most one row per key) without row counts; ``total`` is the number of rows of ``big``.

    The hot keys are found by counting ``big``. Where ``total`` is below the threshold no key can be hot and this is a plain join.
    """
    threshold = hot_threshold(total, least)
    if total < threshold:
        return _columns(big.join(dim, keys, how), big, dim, keys, how)
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") >= threshold)
    hot = F.broadcast(counts.select(*keys, F.ceil(F.col("__rows") * PARTS / threshold).cast("bigint").alias("__parts")))
    return _salted(big, dim.join(hot, keys, "left"), hot, keys, spread, how)


def _columns(joined: DataFrame, big: DataFrame, dim: DataFrame, keys: list[str], how: str) -> DataFrame:
    return joined.select(*big.columns, *[c for c in dim.columns if c not in (*keys, "__parts") and how != "left_semi"])


def _salted(big: DataFrame, dim: DataFrame, hot: DataFrame, keys: list[str], spread: Column, how: str) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    mixed = F.xxhash64(F.lit(11), spread)
    salt = F.when(missing, F.pmod(mixed, F.lit(NULL_PARTS))).when(F.col("__parts").isNotNull(), F.pmod(mixed, F.col("__parts"))).otherwise(F.lit(-1).cast("bigint"))
    left = big.join(hot, keys, "left").withColumn("__salt", salt)
    # Exploded, the dim's salt is no constant that could be folded out of the shuffle keys.
    salts = F.when(F.col("__parts").isNotNull(), F.sequence(F.lit(0).cast("bigint"), F.col("__parts") - 1)).otherwise(F.array(F.lit(-1).cast("bigint")))
    right = dim.withColumn("__salt", F.explode(salts)).drop("__parts")
    return _columns(left.join(right, [*keys, "__salt"], how), big, dim, keys, how)
