"""Reading the step reports: latest rows, possible values, scenes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spelling import canonical, first_folder, is_blank


def number(column: str) -> Column:
    """A double with NaN as null."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def latest(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The row of greatest ``reported_at``, then greatest ``seq``, per key; rows without a key are left out.

    ``max_by`` combines on the map side, so that a key with very many rows sends one row per task.
    """
    named = [F.col(k).isNotNull() for k in keys]
    for condition in named:
        rows = rows.filter(condition)
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct("reported_at", "seq")).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in columns])


def latest_value(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``frame_id`` and the frame's ``value`` (null = impossible) in its latest row that has one."""
    return latest(rows.select("frame_id", "reported_at", "seq", value.alias(name)).filter(F.col(name).isNotNull()), ["frame_id"], [name])


def candidate_score() -> Column:
    """``lora_candidate_score`` where step 7 can produce it, 0 to 110, else null."""
    value = number("lora_candidate_score")
    return F.when(value.between(0, 110), value)


def similarity() -> Column:
    """``identity_similarity_mean`` as a cosine: percentages count as hundredths, at 4 decimals; else null."""
    value = number("identity_similarity_mean")
    return F.when(F.abs(value) <= 1, value).when(F.abs(value) <= 100, F.round(value / 100, 4))


def brightness() -> Column:
    """``face_brightness_mean`` on 0-255: values in (0, 1] are shares of 255, at 1 decimal; else null."""
    value = number("face_brightness_mean")
    return F.when((value > 0) & (value <= 1), F.round(value * 255, 1)).when(value.between(0, 255), value)


def face_dimension() -> Column:
    """``face_min_dimension`` from 1 to the row's ``source_short_edge``, else null."""
    value = F.col("face_min_dimension").cast("double")
    return F.when((value >= 1) & (value <= F.col("source_short_edge")), value)


def quality_score() -> Column:
    """``face_quality_score`` where step 5 can produce it, -30 to 2270, else null."""
    value = number("face_quality_score")
    return F.when(value.between(-30, 2270), value)


def scene_key(scene: Column, filename: Column) -> Column:
    """Canonical scene; the first folder of the file where the scene is blank; ``""`` without either."""
    return F.when(is_blank(scene), canonical(first_folder(filename))).otherwise(canonical(scene))


def frame_scenes(step4: DataFrame) -> DataFrame:
    """``frame_id`` and ``scene`` of each frame's latest step-4 row."""
    return latest(step4.select("frame_id", "reported_at", "seq", "scene_group", "filename"), ["frame_id"], ["scene_group", "filename"]).select("frame_id", scene_key(F.col("scene_group"), F.col("filename")).alias("scene"))
