"""Problem 2: one ranking from several differently scaled scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import prefix_counts
from ..operators.skew import hot_threshold, skew_join
from ..session import cut_lineage

# Coefficients of Acklam's rational approximation of the inverse normal distribution.
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution for ``p`` in (0, 1), error below 2e-9 relative."""
    tail = F.sqrt(-2 * F.ln(F.least(p, 1 - p)))
    outer = _poly(_C, tail) / (_poly(_D, tail) * tail + 1)
    q = p - 0.5
    r = q * q
    inner = _poly(_A, r) * q / (_poly(_B, r) * r + 1)
    return F.when(p < 0.02425, outer).when(p > 1 - 0.02425, -outer).otherwise(inner)


def combine_scores(rows: DataFrame, key: str, scores: dict[str, float], hot_rows: int | None = None, head: float = 0.1) -> DataFrame:
    """Rank records by the weighted mean of their scores' normal quantiles.

    ``scores`` maps columns of ``rows`` (higher is better) to weights. Each score becomes its
    empirical percentile with averaged ties, (smaller + half of equal) / n, then the quantile of the normal
    distribution at it, so that only the order within each score counts and no range outweighs another.
    Records that lack any score or the key are left out; of a repeated key the best value of each score counts.

    Returns ``key``, per score ``<score>_pct``, ``<score>_z`` and ``<score>_better`` (records strictly better), ``n``,
    ``combined``, and ``head_combined`` and ``head_all``. On each score the head is what has fewer than ``head`` of the records strictly above it, and it begins at a quantile: a
    record whose ``combined`` reaches the weighted mean of these beginnings belongs to the head of the ranking (``head_combined``); ``head_all`` are those of them that reach the
    beginning on every score, and no other record can.
    Ranks come from prefix counts over the distinct values, so that no window spans all rows and a value shared by a third of the records is
    one row; it is joined back apart from the others. An empty table gives an empty result.
    """
    names = list(scores)
    ready = rows.select(key, *[F.col(c).cast("double").alias(c) for c in names]).filter(F.col(key).isNotNull())
    for c in names:
        ready = ready.filter(F.col(c).isNotNull() & ~F.isnan(c))
    ready = ready.groupBy(key).agg(*[F.max(c).alias(c) for c in names])
    # -0.0 and 0.0 are one value, also where they are keys.
    long = ready.select(key, F.explode(F.array(*[F.struct(F.lit(i).alias("s"), (F.col(c) + F.lit(0.0)).alias("v")) for i, c in enumerate(names)])).alias("x")).select(key, "x.s", "x.v")
    long = cut_lineage(long)
    count = long.count()
    threshold = hot_threshold(count, hot_rows)
    values = long.groupBy("s", "v").agg(F.count(F.lit(1)).alias("eq"))
    pct = (F.col("below") + F.col("eq") / 2) / F.col("total")
    ranked = prefix_counts(values, "s", "v", "eq").select("s", "v", F.col("eq").alias("rows"), "total", pct.alias("pct"), inverse_normal(pct).alias("z"), (F.col("total") - F.col("below") - F.col("eq")).alias("better"))
    ranked = cut_lineage(ranked)
    placed = skew_join(long, ranked, ["s", "v"], "rows", threshold, F.col(key), "inner", count)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in scores.values()]), F.col("s") + 1)
    parts = []
    for i, c in enumerate(names):
        parts += [F.max(F.when(F.col("s") == i, F.col(x))).alias(f"{c}_{x}") for x in ("pct", "z", "better")]
    # Summed in the order of the scores, not of arrival, so that equal records get equal sums.
    mean = lambda z: F.round(sum((z(i, c) for i, c in enumerate(names)), F.lit(0.0)) / float(sum(scores.values())), 9)
    weights = list(map(float, scores.values()))
    wide = placed.groupBy(key).agg(*parts, F.max("total").alias("n")).withColumn("combined", mean(lambda i, c: F.col(f"{c}_z") * weights[i]))
    # One row: where the head of each score begins.
    begin = ranked.filter(F.col("better") < F.col("total") * head).agg(*[F.min(F.when(F.col("s") == i, F.col("z"))).alias(f"__from{i}") for i in range(len(names))])
    begin = begin.withColumn("__from", mean(lambda i, c: F.col(f"__from{i}") * weights[i]))
    wide = wide.join(F.broadcast(begin), how="left")
    leads = F.coalesce(F.col("combined") >= F.col("__from"), F.lit(False))
    every = F.lit(True)
    for i, c in enumerate(names):
        every = every & (F.col(f"{c}_z") >= F.col(f"__from{i}"))
    return wide.select(key, *[f"{c}_{x}" for c in names for x in ("pct", "z", "better")], "n", "combined", leads.alias("head_combined"), (leads & F.coalesce(every, F.lit(False))).alias("head_all"))


def with_rank(combined: DataFrame, key: str, score: str = "combined") -> DataFrame:
    """Add ``rank``: 1 + records with a strictly greater ``score``; distributed like the percentiles."""
    held = cut_lineage(combined)
    values = held.groupBy(F.lit(0).alias("g"), F.col(score).alias("v")).agg(F.count(F.lit(1)).alias("eq"))
    ranks = prefix_counts(values, "g", "v", "eq").select(F.col("v").alias(score), F.col("eq").alias("rows"), (F.col("total") - F.col("below") - F.col("eq") + 1).alias("rank"))
    count = held.count()
    return skew_join(held, ranks, [score], "rows", hot_threshold(count), F.col(key), "inner", count)
