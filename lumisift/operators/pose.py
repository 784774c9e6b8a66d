"""Pose buckets and context-dependent similarity thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.captions import lookup
from ..params import IdentityParams, PoseParams


def fold_pitch(pitch: Column) -> Column:
    """Euler pitch folded into [-90, 90]."""
    return F.when(pitch > 90, 180.0 - pitch).when(pitch < -90, -180.0 - pitch).otherwise(pitch)


def pose_bucket(yaw: Column, pitch: Column, roll: Column, p: PoseParams = PoseParams()) -> Column:
    """Bucket of a head pose; null where an angle is null or NaN."""
    side = lambda left, right: F.when(yaw > 0, right).otherwise(left)
    known = yaw.isNotNull() & pitch.isNotNull() & roll.isNotNull() & ~F.isnan(yaw) & ~F.isnan(pitch) & ~F.isnan(roll)
    bucket = (
        F.when((F.abs(pitch) > p.extreme_pitch) | (F.abs(roll) > p.extreme_roll), "EXTREME_POSE")
        .when(pitch > p.looking_pitch, "LOOKING_DOWN")
        .when(pitch < -p.looking_pitch, "LOOKING_UP")
        .when(F.abs(yaw) <= p.front_yaw, "FRONT")
        .when(F.abs(yaw) <= p.three_quarter_yaw, side("LEFT_3Q", "RIGHT_3Q"))
        .otherwise(side("LEFT_PROFILE", "RIGHT_PROFILE"))
    )
    return F.when(known, bucket)


def dynamic_threshold(shot: Column, pose: Column, yaw: Column, p: IdentityParams = IdentityParams()) -> Column:
    """Similarity a frame must reach: lower for small faces and turned heads, with a floor."""
    base = lookup(shot, p.base, p.base_default)
    relief = F.when(F.abs(F.coalesce(yaw, F.lit(0.0))) > p.wide_yaw, p.wide_yaw_relief).otherwise(0.0)
    return F.greatest(base + (lookup(pose, p.modifier, p.modifier_default) - relief), F.lit(p.floor))


def similarity_class(similarity: Column, threshold: Column, p: IdentityParams = IdentityParams()) -> Column:
    return F.when(similarity >= threshold, "PASSED").when(similarity >= threshold - p.review_margin, "REVIEW").when(similarity.isNotNull(), "REJECT_IDENTITY")


def bucket_shares(posed: DataFrame, bucket: str) -> DataFrame:
    """Rows per bucket and their share of all in ten-thousandths."""
    counts = posed.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share_e4", F.floor(F.col("n") * 10000 / F.sum("n").over(Window.partitionBy()) + 0.5).cast("bigint"))


def top_clusters(posed: DataFrame, key: str, seq: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent keys, equal counts by first appearance."""
    return posed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first_seq")).orderBy(F.desc("n"), "first_seq").limit(k)
