"""Problem 1: capping records per dominant contributor, and the histogram cutoff it rests on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import prefix_counts
from ..operators.skew import hot_threshold, skew_join
from ..session import cut_lineage

#: Bins of a contributor's quality histogram.
BINS = 2048


def top_by_cutoff(rows: DataFrame, group: str, score: str, tie: str, quota: DataFrame | None, low: float, high: float, bins: int = BINS, hot_rows: int | None = None) -> DataFrame:
    """Flag the ``quota`` best rows of each group: columns of ``rows`` plus ``kept``.

    ``rows`` is materialised once by the caller (see :func:`cut_lineage`) and has a unique ``tie``
    and a non-null ``score``; ``quota`` is a table (group, quota). Method: count rows per (group, score bin), which merges on the map side;
    the cutoff bin of a group is the first from the top at which the running count meets the quota;
    only rows of that bin are ranked, to find the last row kept; all others are
    decided by comparing with it. A bin that the quota takes whole needs no ranking. The borderline rows are range-partitioned by group, score and tie and
    ranked by prefix counts, so that also a bin with a third of all rows, such as one of equal scores, is ranked by many tasks. Equal scores: smaller ``tie`` is better. A
    group without a quota keeps all its rows, a quota of 0 none.
    """
    total = rows.count()
    threshold = hot_threshold(total, hot_rows)
    width = (high - low) or 1.0
    bin_of = F.least(F.greatest(F.floor((F.col(score) - low) * (bins / width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    binned = rows.withColumn("__bin", bin_of)
    hist = binned.groupBy(group, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    hist = hist.join(quota.select(group, "quota"), group)
    down = Window.partitionBy(group).orderBy(F.desc("__bin")).rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        hist.withColumn("__cum", F.sum("__n").over(down))
        .withColumn("__rows", F.sum("__n").over(Window.partitionBy(group)))
        .withColumn("__ahead", F.col("__cum") - F.col("__n"))
        .filter((F.col("__rows") > F.col("quota")) & (F.col("__cum") >= F.col("quota")) & (F.col("__ahead") < F.greatest(F.col("quota"), F.lit(1))))
        .select(group, "__rows", F.col("__bin").alias("__cut"), (F.greatest(F.col("quota"), F.lit(0)) - F.col("__ahead")).alias("__rest"), "__n")
    )
    cuts = cut_lineage(cuts)
    # __rest rows of the bin stay: all, none or some, and only some need the last of them.
    some = cuts.filter("__rest > 0 and __rest < __n").drop("__n")
    border = skew_join(binned.select(group, score, tie, "__bin"), some, [group], "__rows", threshold, F.col(tie), "inner", total).filter(F.col("__bin") == F.col("__cut"))
    place = border.select(group, "__rest", F.struct((-F.col(score)).alias("s"), F.col(tie).alias("t")).alias("__place"), F.lit(1).alias("__one"))
    last = prefix_counts(place, group, "__place", "__one").filter(F.col("below") == F.col("__rest") - 1)
    last = last.select(group, (-F.col("__place.s")).alias("__last_score"), F.col("__place.t").alias("__last_tie"))
    bounds = cuts.join(last, group, "left").select(group, "__rows", "__cut", F.when(F.col("__rest") <= 0, F.lit(1)).otherwise(0).alias("__above"), "__last_score", "__last_tie")
    placed = skew_join(binned, bounds, [group], "__rows", threshold, F.col(tie), "left", total)
    better = (F.col(score) > F.col("__last_score")) | ((F.col(score) == F.col("__last_score")) & (F.col(tie) <= F.col("__last_tie")))
    kept = F.when(F.col("__cut").isNull(), True).when(F.col("__bin") != F.col("__cut"), F.col("__bin") > F.col("__cut")).when(F.col("__last_score").isNotNull(), better).otherwise(F.col("__above") == 0)
    return placed.select(*rows.columns, kept.alias("kept"))


def share_cap(sizes: DataFrame, size: str, share: float) -> int:
    """Largest cap ``c`` with ``c <= share * sum(min(size, c))``, from the sizes of all contributors.

    Contributors of equal size are counted together first, so that the windowed table has one row
    per distinct size (at most the square root of twice the rows). If there are too few contributors
    for the share (fewer than 1 / share), the cap is the smallest contributor's size: equal shares
    are the nearest that can be had.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    by_size = sizes.groupBy(F.col(size).alias("s")).agg(F.count(F.lit(1)).alias("m"))
    up = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    # Caps between this size and the next: whole contributors give a rows, each of the b others gives the cap.
    steps = by_size.select("s", F.sum(F.col("s") * F.col("m")).over(up).alias("a"), (F.sum("m").over(Window.partitionBy()) - F.sum("m").over(up)).alias("b"), F.lead("s").over(Window.orderBy("s")).alias("t"))
    bound = F.when(F.col("b") * share >= 1, F.col("t")).otherwise(F.floor(share * F.col("a") / (1 - share * F.col("b")) + 1e-9))
    best = steps.select(F.least(F.coalesce(F.col("t"), F.col("s")), bound).alias("c"), "s").agg(F.max(F.when(F.col("c") >= F.col("s"), F.col("c"))), F.min("s")).first()
    if best[1] is None:
        return 0
    return int(best[0] if best[0] is not None else best[1])


def cap_contributors(rows: DataFrame, contributor: str, score: str, tie: str, max_count: int | Column | None = None, max_share: float | None = None, low: float | None = None, high: float | None = None, bins: int = BINS, hot_rows: int | None = None) -> DataFrame:
    """Hold every contributor to ``max_count`` rows or ``max_share`` of the rows kept, the best by ``score``.

    ``max_count`` is a number or a Column of the contributor. Rows whose score or ``tie`` is null or
    NaN cannot be ranked and are left out; a null contributor counts as one contributor, for strings named by
    null's place ``""``. Repeated ``tie`` values are one record: its best score counts. Returns
    contributor, score, tie and ``kept``; an empty table gives an empty result. ``low`` and ``high``
    are the score's range for the histogram; they are measured if missing, and only speed depends on them.
    """
    value = F.col(score).cast("double")
    text = dict(rows.dtypes)[contributor] == "string"
    # Other types than strings have no value to stand for null: a pair that is never null is grouped and joined.
    who = contributor if text else "__who"
    key = F.coalesce(F.col(contributor), F.lit("")) if text else F.struct(F.col(contributor).isNull().alias("is_null"), F.col(contributor).alias("value"))
    base = rows.select(key.alias(who), value.alias(score), F.col(tie))
    base = base.filter(F.col(score).isNotNull() & ~F.isnan(score) & F.col(tie).isNotNull()).groupBy(who, tie).agg(F.max(score).alias(score)).select(who, score, tie)
    base = cut_lineage(base)
    if low is None or high is None:
        low, high = base.agg(F.min(score), F.max(score)).first()
        low, high = (0.0, 1.0) if low is None else (low, high)
    if max_share is not None:
        max_count = share_cap(base.groupBy(who).agg(F.count(F.lit(1)).alias("n")), "n", max_share)
    limit = F.lit(max_count) if isinstance(max_count, int) else max_count
    sizes = base.groupBy(who).agg(F.count(F.lit(1)).alias("__all"))
    sizes = sizes if text else sizes.withColumn(contributor, F.col("__who.value"))
    quota = sizes.select(who, limit.cast("bigint").alias("quota"))
    flagged = top_by_cutoff(base, who, score, tie, quota, float(low), float(high), bins, hot_rows=hot_rows)
    return flagged if text else flagged.select(F.col("__who.value").alias(contributor), score, tie, "kept")
