"""Tie-aware percentiles and row numbers, global ones without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import prefix_counts
from .skew import hot_threshold, skew_join


def _value_ranks(rows: DataFrame, columns: dict[str, str], count: str, rank: Column) -> DataFrame:
    """Join ``rank``, a function of a value's rows ``eq`` and the prefix counts of ``count`` (``eq`` rows or ``one`` per value), back to the rows.

    ``columns`` maps value columns to the names of their ranks; the values of all of them are counted and ranked in one pass, each column for itself.
    """
    held = cut_lineage(rows)
    names = list(columns)
    pairs = F.array(*[F.struct(F.lit(i).alias("g"), F.col(c).cast("double").alias("v")) for i, c in enumerate(names)])
    # -0.0 and 0.0 are one value, also where they are keys.
    real = held.select(F.explode(pairs).alias("x")).select("x.g", (F.col("x.v") + F.lit(0.0)).alias("v")).filter("v is not null and not isnan(v)")
    values = real.groupBy("g", "v").agg(F.count(F.lit(1)).alias("eq")).withColumn("one", F.lit(1).cast("bigint"))
    ranked = prefix_counts(values, "g", "v", count).select("g", F.col("v").alias("__v"), F.col("eq").alias("__rows"), rank.alias("__rank"))
    ranked = cut_lineage(ranked) if len(names) > 1 else ranked
    total = held.count()
    out = held
    for i, (c, name) in enumerate(columns.items()):
        own = ranked.filter(F.col("g") == i).select("__v", "__rows", F.col("__rank").alias(name))
        keyed = out.withColumn("__v", F.col(c).cast("double") + F.lit(0.0))
        out = skew_join(keyed, own, ["__v"], "__rows", hot_threshold(total), F.col(rows.columns[0]), "left", total).drop("__v")
    return out


def dense_percentile(rows: DataFrame, value: str, out: str, **more: str) -> DataFrame:
    """100 * (dense rank - 1) / (distinct values - 1), at two decimals; 100 for a single value, null for null and NaN. ``more`` maps further value columns to their names."""
    pct = F.when(F.col("total") == 1, 100.0).otherwise(F.floor(F.col("below") * 100.0 / (F.col("total") - 1) * 100 + 0.5) / 100)
    return _value_ranks(rows, {value: out, **more}, "one", pct)


def midrank_percentile(rows: DataFrame, value: str, out: str, **more: str) -> DataFrame:
    """100 * mean zero-based rank of the tie block / (n - 1); 100 for a single row, null for null and NaN. ``more`` as in :func:`dense_percentile`."""
    pct = F.when(F.col("total") == 1, 100.0).otherwise((F.col("below") + (F.col("eq") - 1) / 2) / (F.col("total") - 1) * 100)
    return _value_ranks(rows, {value: out, **more}, "eq", pct)


def global_row_number(rows: DataFrame, order: list[Column], out: str) -> DataFrame:
    """1-based position under ``order`` (which must decide every pair of rows): range partitions are numbered one by one from their sizes."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(rows.withColumns({f"__o{i}": o for i, o in enumerate(order)}).repartitionByRange(n, *[f"__o{i}" for i in range(len(order))]).withColumn("__part", F.spark_partition_id()))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    ahead = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__ahead"))  # one row per partition
    inside = Window.partitionBy("__part").orderBy(*[f"__o{i}" for i in range(len(order))])
    numbered = placed.join(F.broadcast(ahead), "__part").withColumn(out, (F.col("__ahead") + F.row_number().over(inside)).cast("bigint"))
    return numbered.select(*rows.columns, out)


def best_per_group(rows: DataFrame, group: list[str], score: str, seq: str) -> DataFrame:
    """The row of greatest ``score`` per group, ties to the smallest ``seq``; a null score loses to any. Combined on the map side."""
    order = F.struct(F.coalesce(F.col(score).cast("double"), F.lit(float("-inf"))), -F.col(seq))
    kept = [c for c in rows.columns if c not in group]
    return rows.groupBy(*group).agg(F.max_by(F.struct(*kept), order).alias("__r")).select(*group, *[F.col(f"__r.{c}").alias(c) for c in kept])


def first_n(rows: DataFrame, seq: str, n: int) -> DataFrame:
    """First ``n`` rows by ``seq``; all of them where ``n`` is 0 or less."""
    return rows.orderBy(seq).limit(n) if n > 0 else rows


def primary_box(rows: DataFrame, key: list[str], width: str, height: str, seq: str) -> DataFrame:
    """Per key the row with the box of greatest area, the first of equals."""
    boxed = rows.withColumn("box_area", F.col(width).cast("bigint") * F.col(height))
    return best_per_group(boxed.filter(F.col("box_area").isNotNull()), key, "box_area", seq)


def nearest_point(rows: DataFrame, key: list[str], x: str, y: str, centre_x: Column, centre_y: Column, seq: str) -> DataFrame:
    """Per key the row whose point lies nearest (squared distance) to a centre, the first of equals."""
    gap = (F.col(x) - centre_x) * (F.col(x) - centre_x) + (F.col(y) - centre_y) * (F.col(y) - centre_y)
    return best_per_group(rows.withColumn("gap", gap).withColumn("nearness", -F.col("gap")).filter(F.col("gap").isNotNull()), key, "nearness", seq).drop("nearness")
