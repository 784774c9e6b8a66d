"""Summaries: counts, shares, statistics, funnels and review ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.math import quantised


def share_e4(n: Column, total: Column) -> Column:
    """A share in ten-thousandths, half up; 0 of nothing."""
    return F.floor(n * 10000 / F.greatest(total, F.lit(1)) + 0.5).cast("bigint")


def counts_with_share(rows: DataFrame, by: str) -> DataFrame:
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share_e4", share_e4(F.col("n"), F.sum("n").over(Window.partitionBy())))


def statistics_by(rows: DataFrame, group: str, value: str, low: float = 40.0, high: float = 235.0) -> DataFrame:
    """Mean, population deviation and variance, mean of squares, 10th and 90th percentile and the shares below and above two bounds, as integers at 3 decimals (the contrast, an interpolated value, at 6).

    Null and NaN values do not count.
    """
    v = F.col(value)
    real = rows.filter(v.isNotNull() & ~F.isnan(v))
    stats = real.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        quantised(F.avg(v), 3).alias("mean_e3"),
        quantised(F.stddev_pop(v), 3).alias("std_e3"),
        quantised(F.var_pop(v), 3).alias("var_e3"),
        quantised(F.avg(v * v), 3).alias("square_e3"),
        F.percentile(v, F.array(F.lit(0.1), F.lit(0.9))).alias("p"),
        quantised(F.avg((v < low).cast("double")), 3).alias("low_e3"),
        quantised(F.avg((v > high).cast("double")), 3).alias("high_e3"),
    )
    return stats.withColumn("contrast_e6", quantised(F.col("p")[1] - F.col("p")[0], 6)).drop("p")


def summary_text(rows: DataFrame, value: str) -> DataFrame:
    """``min / median / max`` at two decimals in one row, ``n/a`` without values."""
    v = F.col(value)
    real = F.when(~F.isnan(v), v)
    shown = [F.format_string("%.2f", F.floor(x * 100 + 0.5) / 100) for x in (F.min(real), F.median(real), F.max(real))]
    return rows.agg(F.when(F.count(real) > 0, F.concat_ws(" / ", *shown)).otherwise("n/a").alias("summary"))


def funnel(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows left after each named stage, and their share of the first."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), "n") for i, (name, df) in enumerate(stages)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("share_e4", share_e4(F.col("n"), F.first("n").over(Window.partitionBy().orderBy("stage_no"))))


def flag_funnel(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """The same funnel in one pass: rows for which each flag and all before it hold."""
    so_far, sums = F.lit(True), []
    for name, flag in flags.items():
        so_far = so_far & F.coalesce(flag, F.lit(False))
        sums.append(F.count_if(so_far).alias(name))
    total = rows.agg(F.count(F.lit(1)).alias("all"), *sums)
    items = F.array(*[F.struct(F.lit(i).alias("stage_no"), F.lit(n).alias("stage"), F.col(n).alias("n")) for i, n in enumerate(["all", *flags])])
    return total.select(F.explode(items).alias("x"), "all").select("x.stage_no", "x.stage", "x.n", share_e4(F.col("x.n"), F.col("all")).alias("share_e4"))


def ratio_against_target(rows: DataFrame, by: str, targets: dict[str, float]) -> DataFrame:
    """Actual share per value in ten-thousandths against its target in per cent; targets without rows are listed at 0."""
    dim = rows.sparkSession.createDataFrame(list(targets.items()), f"{by} string, target_pct double")
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(F.broadcast(dim), by, "full").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.withColumn("share_e4", share_e4(F.col("n"), F.sum("n").over(Window.partitionBy())))


def class_shares(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """One row: how many rows have each value, and all evaluated rows."""
    return rows.agg(F.count(column).alias("evaluated"), *[F.count_if(F.col(column) == v).alias(v.lower()) for v in values])
