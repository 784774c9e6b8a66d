"""Joins by name: last row wins, defaults, and the substring join without a cross product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import hot_threshold, spread_join

#: Length of the pieces by which a substring join blocks.
PIECE = 8


def last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """One row per key, that of greatest ``seq``; null and empty keys are left out."""
    kept = [c for c in rows.columns if c != key]
    return rows.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.max_by(F.struct(*kept), F.col(seq)).alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in kept])


def first_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """One row per key, that of smallest ``seq``."""
    kept = [c for c in rows.columns if c != key]
    return rows.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.min_by(F.struct(*kept), F.col(seq)).alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in kept])


def lookup_join(left: DataFrame, right: DataFrame, key: str, seq: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join to the last row of each key, with defaults for what is not found. A key with a large part of the left rows is dealt out over many tasks."""
    out = spread_join(left, last_wins(right, key, seq), [key], F.struct(*left.columns), left.count(), "left")
    for c, value in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(value)))
    return out


def substring_join(names: DataFrame, name: str, key_rows: DataFrame, key: str, seq: str, piece: int = PIECE, least: int | None = None) -> DataFrame:
    """Each row of ``names`` with the first ``key`` (smallest ``seq``) that its ``name`` contains; null without one.

    Every name is cut into its substrings of ``piece`` characters, and each key is looked for under the one of its own pieces that the fewest other keys have (shorter keys
    under themselves), so that keys with a common beginning or ending do not all meet all names. Empty and null keys are skipped; of equal keys the first
    counts. A piece or name with a large part of all rows is dealt out over many tasks (``least`` as in :func:`spread_join`).
    """
    keys = first_wins(key_rows.select(key, seq), key, seq).withColumn("__len", F.least(F.length(key), F.lit(piece)))
    own = keys.select(key, seq, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key) - F.col("__len") + 1), lambda i: F.substr(F.col(key), i, F.col("__len"))))).alias("__piece"))
    own = cut_lineage(own)
    by_length = {r[0]: r[1] for r in own.groupBy(F.length("__piece")).count().collect()}  # at most ``piece`` lengths
    lengths = sorted(by_length)
    if not lengths:
        return names.withColumn(key, F.lit(None).cast("string"))
    counts = own.groupBy("__piece").agg(F.count(F.lit(1)).alias("__n"))
    rarest = spread_join(own, counts, ["__piece"], F.col(key), sum(by_length.values()), "inner", least).groupBy(key, seq).agg(F.min_by("__piece", F.struct("__n", "__piece")).alias("__piece"))
    # One row per piece, so that a piece of very many names is joined like any hot key.
    wanted = rarest.groupBy("__piece").agg(F.collect_list(F.struct(F.col(key).alias("k"), F.col(seq).alias("s"))).alias("__keys"))
    distinct = names.select(name).filter(F.col(name).isNotNull()).distinct()
    cuts = [F.transform(F.sequence(F.lit(1), F.greatest(F.length(name) - (n - 1), F.lit(1))), _cut(name, n)) for n in lengths]
    pieces = distinct.select(name, F.explode(F.array_distinct(F.concat(*cuts) if len(cuts) > 1 else cuts[0])).alias("__piece"))
    # A name has fewer pieces than characters, of each length, and each piece once: no piece has more rows than there are names.
    most, rows = names.agg(F.sum(F.length(name)), F.count(F.lit(1))).first()
    met = spread_join(pieces, wanted, ["__piece"], F.col(name), rows, "inner", hot_threshold((most or 0) * len(lengths), least))
    hits = met.select(name, F.explode("__keys").alias("__k")).filter(F.col(name).contains(F.col("__k.k")))
    best = hits.groupBy(name).agg(F.min_by("__k.k", F.col("__k.s")).alias(key))
    return spread_join(names, best, [name], F.struct(*names.columns), rows, "left", least)


def _cut(name: str, n: int):
    return lambda i: F.substr(F.col(name), i, F.lit(n))


def semi(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``."""
    return left.join(right.select(key).distinct(), key, "left_semi")


def anti(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def eligible(rows: DataFrame, flag: str = "face_eligible") -> DataFrame:
    return rows.filter(F.col(flag))


def condition_rows(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows where a condition holds; null is no."""
    return rows.filter(F.coalesce(condition, F.lit(False)))
