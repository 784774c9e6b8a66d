"""Centroids, anchor banks and cosine similarity of embedding columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.math import dot, norm
from .skew import spread_join


def reference_bank(vectors: DataFrame, group: str, key: str, first: int = 20) -> DataFrame:
    """The first ``first`` vectors of each group by ``key``; the limit is applied before the shuffle."""
    w = Window.partitionBy(group).orderBy(key)
    return vectors.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= first).drop("__rn")


def centroids(bank: DataFrame, group: str, vector: str) -> DataFrame:
    """Element-wise mean of each group's vectors, scaled to unit length."""
    parts = bank.select(group, F.posexplode(vector).alias("pos", "x")).groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    arrays = parts.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("s")).select(group, F.transform("s", lambda e: e["m"]).alias("raw"))
    return arrays.select(group, F.transform("raw", lambda x: x / F.greatest(norm(F.col("raw")), F.lit(1e-12))).alias("centroid"))


def anchors(bank: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """Each group's bank as one array of vectors (as long as the bank's limit)."""
    return bank.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct(key, vector))), lambda e: e[vector]).alias("anchors"))


def similarities(vectors: DataFrame, group: str, key: str, vector: str, first: int = 20) -> DataFrame:
    """Cosine to the group's centroid (``similarity_mean``) and the greatest to its anchors (``similarity_max``).

    A group's centroid and anchors are one row, joined by group: a vector meets one row, whatever the size of the bank. The vectors of a group with a large
    part of all rows are dealt out over many tasks.
    """
    bank = reference_bank(vectors.select(group, key, vector), group, key, first)
    refs = centroids(bank, group, vector).join(anchors(bank, group, key, vector), group)
    rows = vectors.select(group, key, vector)
    joined = spread_join(rows, refs, [group], F.col(key), rows.count(), "inner")
    unit = norm(F.col(vector))
    best = F.array_max(F.transform("anchors", lambda a: dot(F.col(vector), a) / F.greatest(unit * norm(a), F.lit(1e-12))))
    return joined.select(key, group, (dot(F.col(vector), F.col("centroid")) / F.greatest(unit, F.lit(1e-12))).alias("similarity_mean"), best.alias("similarity_max"))
