"""Quality gate: shot type, eye, skin and visibility rules, reasons and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.captions import lookup
from ..functions.math import clamp, guarded_ratio
from ..params import GateParams

# Categories by falling priority, each with the reasons that lead to it.
CATEGORY_REASONS = (
    ("REVIEW_UNKNOWN", ("analysis_error",)),
    ("REJECT_NO_FACE", ("no_face",)),
    ("REJECT_MULTIPLE_FACE", ("multiple_faces",)),
    ("REJECT_LOW_RES", ("low_resolution_source",)),
    ("REJECT_BEAUTY_FILTER", ("beauty_filter_detected", "plastic_skin")),
    ("REJECT_OCCLUSION", ("low_visibility", "hair_covered_face", "eye_occluded", "one_eye_occluded", "face_underexposed", "face_backlit_underexposed")),
    ("REJECT_BLUR", ("face_blurry", "global_blurry")),
    ("REJECT_SMALL_FACE", ("face_too_small",)),
)
CATEGORY_DEFAULT = "REVIEW_UNKNOWN"
OCCLUSION_LEVELS = ((90.0, "none"), (80.0, "mild"), (70.0, "moderate"))
OCCLUSION_LAST = "heavy"


def shot_type(area: Column, p: GateParams = GateParams()) -> Column:
    """Framing from the face's share of the picture; null without one."""
    return F.when(area >= p.close_up_area, "CLOSE_UP").when(area >= p.full_body_area, "UPPER_BODY").when(area.isNotNull(), "FULL_BODY")


def eyes_valid(left: Column, right: Column, p: GateParams = GateParams()) -> Column:
    low, high = F.least(left, right), F.greatest(left, right)
    return (low >= p.min_single_eye) & ((left + right) / 2 >= p.min_mean_eye) & (guarded_ratio(high, low, 1e-4) <= p.max_eye_asymmetry)


def beauty_filter(shot: Column, texture: Column, plasticity: Column, mesh: Column, p: GateParams = GateParams()) -> Column:
    """Over-smoothed skin: too little texture for the framing or too much sharpness over it; never for FULL_BODY or without a mesh."""
    least = F.when(shot == "CLOSE_UP", p.min_skin_texture_close_up).when(shot == "UPPER_BODY", p.min_skin_texture_upper_body)
    return F.coalesce(mesh & least.isNotNull() & ((texture < least) | (plasticity > p.max_plasticity_ratio)), F.lit(False))


def visibility_signals(confidence: Column, outside: Column, eye_left: Column, eye_right: Column, brightness_ratio: Column, texture_ratio: Column, touches_edge: Column, mesh: Column, box_filled: Column) -> Column:
    """Struct of score, level, occluded and signals; without a mesh or box the score is 0 and the level unknown."""
    low, high = F.least(eye_left, eye_right), F.greatest(eye_left, eye_right)
    rules = (
        ("low_detection_confidence", confidence < 0.60, F.lit(25.0)),
        ("moderate_detection_confidence", (confidence >= 0.60) & (confidence < 0.75), F.lit(12.0)),
        ("implausible_face_landmarks", outside > 0, F.least(outside * 15.0, F.lit(45.0))),
        ("asymmetric_eye_visibility", (low < 0.07) & (high > 0.16), F.lit(35.0)),
        ("asymmetric_eye_brightness", brightness_ratio > 0.35, F.lit(25.0)),
        ("asymmetric_eye_detail", texture_ratio < 0.30, F.lit(15.0)),
        ("face_touches_image_edge", touches_edge, F.lit(20.0)),
    )
    signals = F.array_compact(F.array(*[F.when(hit, name) for name, hit, _ in rules]))
    score = F.lit(100.0)
    for _, hit, malus in rules:
        score = score - F.when(hit, malus).otherwise(0.0)
    score = clamp(score, 0.0, 100.0)
    level = F
    for bound, name in OCCLUSION_LEVELS:
        level = level.when(score >= bound, name)
    level = level.otherwise(OCCLUSION_LAST)
    failed = F.when(~F.coalesce(mesh, F.lit(False)), F.array(F.lit("landmarks_not_found"))).when(~F.coalesce(box_filled, F.lit(False)), F.array(F.lit("empty_face_box")))
    level = F.when(failed.isNull(), level).otherwise("unknown")
    return F.struct(
        F.when(failed.isNull(), score).otherwise(0.0).alias("score"),
        level.alias("level"),
        level.isin("moderate", "heavy", "unknown").alias("occluded"),
        F.coalesce(failed, signals).alias("signals"),
    )


def gate_reasons(p: GateParams = GateParams()) -> Column:
    """Reasons against a frame, in rule order, from the report's columns; an empty array means eligible.

    Missing inputs count as the least favourable value where a rule has one (Laplacian, visibility, texture)
    and as neutral otherwise (backlight ratio 1). Rules on the face need ``face_detected``; the global
    blur rule holds for every row, and an error row without a face count also counts as multiple faces.
    """
    c = F.col
    num = lambda x, default=None: F.coalesce(F.when(~F.isnan(c(x)), c(x)), F.lit(default)) if default is not None else F.when(~F.isnan(c(x)), c(x))
    error = c("face_gate_status") == "error"
    face = F.coalesce(c("face_detected"), F.lit(False))
    shot = F.coalesce("shot_type", F.lit("UPPER_BODY"))
    full = shot == "FULL_BODY"
    least_dim = F.when(full, p.min_face_dim_full_body).when(shot == "CLOSE_UP", p.min_face_dim_close_up).otherwise(p.min_face_dim_upper_body)
    brightness = num("face_brightness_mean", 0.0)
    eyes = F.coalesce(c("eye_presence_valid"), F.lit(False))
    no_face = ~error & ~face
    under = brightness < p.min_brightness
    blurry = (~full & (num("eye_sharpness", 0.0) < p.min_eye_sharpness)) | (num("face_laplacian_score", 0.0) < p.min_face_laplacian)
    rules = [
        ("analysis_error", error),
        ("no_face", no_face),
        ("multiple_faces", ~no_face & ~F.coalesce(c("face_count") == 1, F.lit(False))),
        ("global_blurry", num("laplacian_score", 0.0) < p.min_global_laplacian),
        ("low_resolution_source", face & full & (c("source_short_edge") < p.min_source_short_edge_fullbody)),
        ("face_too_small", face & (F.coalesce("face_min_dimension", F.lit(0)) < least_dim)),
        ("low_visibility", face & (~F.coalesce(c("facemesh_detected"), F.lit(False)) | (num("face_visibility_score", -1.0) < p.min_visibility))),
        ("hair_covered_face", face & (num("face_central_gradient") > p.max_central_gradient)),
        ("one_eye_occluded", face & ~full & ~eyes),
        ("face_underexposed", face & under),
        ("face_backlit_underexposed", face & ~under & (brightness < p.backlit_brightness) & (num("face_to_global_brightness_ratio", 1.0) < p.min_backlit_ratio)),
        ("beauty_filter_detected", face & F.coalesce(c("beauty_filter_detected"), F.lit(False)) & F.lit(not p.skip_beauty_filter)),
        ("face_blurry", face & blurry),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(hit, F.lit(False)), name) for name, hit in rules]))


def gate_category(reasons: Column) -> Column:
    """The category of greatest priority among the reasons; ELIGIBLE without any."""
    out = F.when(F.size(reasons) == 0, "ELIGIBLE")
    for name, tokens in CATEGORY_REASONS:
        out = out.when(F.arrays_overlap(reasons, F.array(*map(F.lit, tokens))), name)
    return out.otherwise(CATEGORY_DEFAULT)


def apply_gate(report: DataFrame, p: GateParams = GateParams()) -> DataFrame:
    """Report with fresh ``face_gate_reason``, ``face_eligible`` and ``face_gate_category``; earlier values are recomputed, not kept."""
    marked = report.withColumn("face_gate_reason", gate_reasons(p))
    return marked.withColumn("face_eligible", F.size("face_gate_reason") == 0).withColumn("face_gate_category", gate_category(F.col("face_gate_reason")))


def rounded_inputs(report: DataFrame) -> DataFrame:
    """The gate's inputs at the decimals at which a CSV report keeps them, for results as read back from disk."""
    digits = {"face_brightness_mean": 1, "face_central_gradient": 1, "eye_sharpness": 3, "mouth_sharpness": 3, "face_to_global_brightness_ratio": 3, "face_laplacian_score": 3, "face_visibility_score": 1}
    return report.withColumns({c: F.bround(c, d) for c, d in digits.items() if c in report.columns})


__all__ = ["apply_gate", "beauty_filter", "eyes_valid", "gate_category", "gate_reasons", "lookup", "rounded_inputs", "shot_type", "visibility_signals"]
