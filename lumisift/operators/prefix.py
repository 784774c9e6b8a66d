"""Exact global prefix counts without a one-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def prefix_counts(values: DataFrame, group: str, value: str, count: str, partitions: int | None = None) -> DataFrame:
    """Add ``below`` (sum of ``count`` over smaller values of the group) and ``total`` of the group.

    ``values`` has one row per (group, value) and keeps its other columns. The rows are range-partitioned and written once, so
    that a partition number names the same values in each later read; the totals per group and partition are
    summed in front of it and only rows of one partition are windowed together. The totals meet the rows under the keys of that window, so that the join
    needs no shuffle of the rows and no broadcast. An empty input gives an empty result.
    """
    n = partitions or int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(values.repartitionByRange(n, group, value).withColumn("__part", F.spark_partition_id()))
    sums = placed.groupBy(group, "__part").agg(F.sum(count).alias("__sum"))
    ahead = Window.partitionBy(group).orderBy("__part")
    sums = sums.select(group, "__part", (F.sum("__sum").over(ahead) - F.col("__sum")).alias("__before"), F.sum("__sum").over(Window.partitionBy(group)).alias("total"))
    inside = Window.partitionBy(group, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("__inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
        .join(sums, [group, "__part"])
        .withColumn("below", F.col("__before") + F.col("__inside"))
        .select(*values.columns, "below", "total")
    )
