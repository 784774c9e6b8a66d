"""Equidistant sampling of a time interval: one row per video becomes one per frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import frame_name, stem
from ..params import ExtractParams


def frame_plan(videos: DataFrame, video: str = "video", duration: str = "duration_sec", p: ExtractParams = ExtractParams()) -> DataFrame:
    """``video``, ``idx`` (from 1), ``t`` (seconds) and ``frame`` for every planned frame.

    The first and last frames lie at the ends of the trimmed interval; an interval that trimming empties is cut by a share at each end
    instead. One frame lies in the middle. Videos without a positive duration give no rows.
    """
    n = max(p.num_frames, 1)
    d = F.col(duration)
    trimmed = d - p.trim_end > p.trim_start
    start = F.when(trimmed, F.lit(p.trim_start)).otherwise(d * p.fallback_share)
    end = F.when(trimmed, d - p.trim_end).otherwise(d * (1 - p.fallback_share))
    base = videos.filter((d > 0) & ~F.isnan(d)).select(video, start.alias("__s"), end.alias("__e"))
    if n == 1:
        rows = base.select(video, F.lit(1).alias("idx"), ((F.col("__s") + F.col("__e")) / 2).alias("t"))
    else:
        rows = base.select(video, "__s", "__e", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
        rows = rows.select(video, (F.col("i") + 1).alias("idx"), (F.col("__s") + F.col("i") * ((F.col("__e") - F.col("__s")) / (n - 1))).alias("t"))
    return rows.withColumn("frame", frame_name(stem(F.col(video)), F.col("idx")))


def extract_summary(planned: DataFrame, extracted: DataFrame, video: str = "video") -> DataFrame:
    """Target and extracted frames per video: ``extracted`` names the frames that exist."""
    return planned.join(extracted.select("frame").distinct().withColumn("ok", F.lit(1)), "frame", "left").groupBy(video).agg(F.count("ok").alias("frames_extracted"), F.count(F.lit(1)).alias("target_frames"))
