"""Problem 6: a sample that matches target category proportions, with floors and a shortfall report."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spelling import canonical, is_blank
from ..operators.skew import hot_threshold, skew_join
from ..session import cut_lineage
from .capping import top_by_cutoff
from .reports import latest


def allocate(share: np.ndarray, floor: np.ndarray, available: np.ndarray, size: int) -> np.ndarray:
    """Integer quotas near ``share * size`` that sum to ``size`` where floors and availability allow it.

    Every category gets its floor (or all it has) and never more than it has; what one category cannot use goes to the others
    in proportion to their shares: the scale of the shares is bisected, then whole numbers are taken by the largest remainder,
    ties to the earlier category. Floors come first if they exceed ``size``.
    """
    available = np.maximum(available, 0)
    low, high = np.minimum(np.maximum(floor, 0), available).astype(float), available.astype(float)
    want = float(min(size, high.sum()))
    share = np.where(np.isfinite(share) & (share > 0), share, 0.0)
    share = share / share.max() if share.any() else share
    share[share < 1e-9] = 0.0
    fill = lambda scale: np.clip(scale * share, low, high)
    if low.sum() >= want:
        return low.astype(np.int64)
    goal = min(want, np.where(share > 0, high, low).sum())
    a, b = 0.0, 1.0
    while fill(b).sum() < goal - 1e-9:
        b *= 2
    for _ in range(200):
        mid = (a + b) / 2
        a, b = (mid, b) if fill(mid).sum() < goal else (a, mid)
    exact = fill(b)
    quota = np.floor(exact + 1e-9).astype(np.int64)
    for i in np.argsort(-(exact - quota), kind="stable"):
        if quota.sum() >= goal:
            break
        quota[i] += quota[i] < high[i]
    for i in np.argsort(-(high - quota), kind="stable"):  # categories without a share take what is still open
        quota[i] += int(min(high[i] - quota[i], max(0, want - quota.sum())))
    return quota


def _allocate(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("category", kind="stable")
    size = int(np.nan_to_num(pdf["sample_size"].max()))
    available = pdf["available"].to_numpy(float)
    pdf["quota"] = allocate(pdf["target_share"].to_numpy(float), pdf["min_count"].fillna(0).to_numpy(float), available, size)
    # What the cap takes from a category's target before the rest is shared out among the others.
    pdf["shortfall"] = np.maximum(pdf["needed"].to_numpy(float) - available, 0.0)
    return pdf


def quota_report(members: DataFrame, targets: DataFrame, category: str = "category") -> DataFrame:
    """Per request and category: ``available``, ``needed`` (the larger of floor and target), ``quota``, ``shortfall``, ``unmet``.

    ``members`` has one row per record with its ``category``; ``targets`` has request_id, category, target_share, min_count and sample_size.
    Members are counted on the map side. Missing minimum, share or size counts as 0; an absent
    category has 0 available. A category is ``unmet`` if its quota stays below what it needs because it has too few records; one whose quota is
    lower only because the floors of others leave less is not. Only a request's categories come together in one task.
    """
    counts = members.groupBy(category).agg(F.count(F.lit(1)).alias("available"))
    joined = targets.join(counts, category, "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("bigint"))
    # Rounded far below any share's precision: 0.07 * 100 is 7, not 7.000000000000001.
    needed = F.greatest(F.coalesce(F.col("min_count").cast("double"), F.lit(0.0)), F.round(F.coalesce(F.col("target_share") * F.col("sample_size"), F.lit(0.0)), 9))
    joined = joined.withColumn("needed", needed)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields]
    out = joined.groupBy("request_id").applyInPandas(_allocate, ", ".join([*fields, "quota bigint", "shortfall double"]))
    return out.withColumn("unmet", (F.col("quota") < F.col("needed")) & (F.col("shortfall") > 0))


def draw_sample(members: DataFrame, report: DataFrame, key: str, category: str = "category", seed: int = 7, hot_rows: int | None = None) -> DataFrame:
    """The ``quota`` records of smallest random key per request and category: request_id, category, ``key``.

    The random key is a hash of ``seed`` and the record, so that the draw can be repeated. A category's cutoff is found from a histogram of
    the keys and only the records of one bin are ranked (:func:`top_by_cutoff`), so a category with a third of all records is never sorted as a whole.
    """
    drawn = cut_lineage(report.filter("quota > 0").select("request_id", category, "quota"))
    sizes = members.groupBy(category).agg(F.count(F.lit(1)).alias("rows"))
    wanted = drawn.groupBy(category).agg(F.collect_list(F.struct("request_id", "quota")).alias("requests"))
    count = members.count()
    placed = skew_join(members, wanted.join(sizes, category), [category], "rows", hot_threshold(count), F.col(key), "inner", count)
    rows = placed.select(key, category, F.explode("requests").alias("x")).select(key, category, F.col("x.request_id").alias("request_id"))
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("request_id"), F.col(key)), F.lit(1 << 52)) / float(1 << 52)
    rows = cut_lineage(rows.withColumn("stratum", F.concat_ws("|", "request_id", category)).withColumn("u", -u))
    quota = drawn.select(F.concat_ws("|", "request_id", category).alias("stratum"), "quota")
    kept = top_by_cutoff(rows, "stratum", "u", key, quota, -1.0, 0.0, hot_rows=hot_rows)
    return kept.filter("kept").select("request_id", category, key)


def cell_of(shot: Column, pose: Column, cell: Column) -> Column:
    """Canonical quota cell of a row; the recorded cell where shot type or pose bucket is missing."""
    return F.when(is_blank(shot) | is_blank(pose), canonical(cell)).otherwise(F.concat(canonical(shot), canonical(pose)))


def cell_members(step7: DataFrame) -> DataFrame:
    """``frame_id`` and ``category`` of the frames whose latest step-7 row has a non-blank quota_status."""
    rows = latest(step7, ["frame_id"], ["shot_type", "pose_bucket", "quota_cell", "quota_status"])
    rows = rows.filter(~is_blank(F.col("quota_status")))
    return rows.select("frame_id", cell_of(F.col("shot_type"), F.col("pose_bucket"), F.col("quota_cell")).alias("category"))


def cell_targets(targets: DataFrame) -> DataFrame:
    """quota_targets with the canonical ``category`` of each cell."""
    return targets.withColumn("category", F.concat(canonical(F.col("shot_type")), canonical(F.col("pose_bucket"))))
