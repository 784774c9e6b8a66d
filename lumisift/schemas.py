"""Column names and types of the step reports, and the domains of their enumerations."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the reports, in their order on disk, and the values of the enumerations.
STEP1 = "video string, duration_sec double, frames_extracted int, target_frames int, output_folder string"
STEP2 = (
    "step_name string, filename string, width int, height int, laplacian_score double, tenengrad_score double, brightness_mean double, brightness_std double, "
    "shadow_pixel_ratio double, highlight_pixel_ratio double, contrast_p90_p10 double, file_size_bytes bigint, laplacian_percentile double, tenengrad_percentile double, "
    "quality_rank int, status string, error string"
)
STEP3_NEW = (
    "shot_type string, source_short_edge int, face_detected boolean, face_count int, multiple_faces boolean, face_bbox_x int, face_bbox_y int, face_bbox_width int, face_bbox_height int, "
    "face_min_dimension int, face_area_ratio double, facemesh_detected boolean, face_brightness_mean double, face_to_global_brightness_ratio double, face_central_gradient double, "
    "left_eye_presence_ratio double, right_eye_presence_ratio double, eye_presence_valid boolean, eye_sharpness double, mouth_sharpness double, skin_texture_score double, "
    "plasticity_ratio double, beauty_filter_detected boolean, face_laplacian_score double, face_tenengrad_score double, face_laplacian_percentile double, face_tenengrad_percentile double, "
    "face_sharpness_score double, face_visibility_score double, occlusion_detected boolean, occlusion_level string, face_visibility_signals array<string>, eye_ratio_left double, "
    "eye_ratio_right double, eye_brightness_ratio double, eye_texture_ratio double, face_eligible boolean, face_gate_category string, face_gate_reason array<string>, "
    "face_gate_status string, face_gate_error string"
)
STEP4_NEW = "pose_yaw double, pose_pitch double, pose_roll double, pose_bucket string, pose_cluster_key string, scene_group string, temporal_index int, pose_status string, pose_error string"
STEP5_NEW = "duplicate_group string, group_size int, group_best string, duplicate_status string, face_quality_score double, phash_distance_to_group_best int, angle_distance_to_group_best double, duplicate_error string"
STEP6_NEW = "identity_similarity_mean double, identity_similarity_max double, identity_threshold double, identity_passed boolean, identity_rank int, identity_error string"
STEP7_NEW = "lora_candidate_score double, candidate_selected boolean, candidate_rank int, quota_cell string, quota_status string, selection_reason string"
STEP9 = (
    "step_name string, filename string, shot_type string, pose_bucket string, face_min_dimension int, eye_sharpness double, restoration_status string, identity_sim_before double, "
    "identity_sim_after double, delta_identity double, fidelity_to_orig double, restoration_reason string"
)
STEP10 = (
    "step_name string, final_filename string, original_filename string, shot_type string, pose_bucket string, width int, height int, aligned_width int, aligned_height int, restoration_status string, "
    "clothing_desc string, hair_desc string, expression_desc string, bg_desc string, lighting_desc string, flux_caption string, tags_caption string"
)
SHOT_TYPES = ("CLOSE_UP", "UPPER_BODY", "FULL_BODY")
POSE_BUCKETS = ("FRONT", "LEFT_3Q", "RIGHT_3Q", "LEFT_PROFILE", "RIGHT_PROFILE", "LOOKING_UP", "LOOKING_DOWN", "EXTREME_POSE")
POSE_NAME_ORDER = ("FRONT", "LEFT_3Q", "RIGHT_3Q", "LEFT_PROFILE", "RIGHT_PROFILE", "LOOKING_DOWN", "LOOKING_UP")
STEP_NAMES = {2: "STEP2_TECHNICAL_METRICS", 3: "STEP3_FACE_GATE", 4: "STEP4_POSE_CLASSIFICATION", 5: "STEP5_FACE_DEDUPLICATION", 6: "STEP6_IDENTITY_EVALUATION", 7: "STEP7_LORA_CANDIDATE_SELECTION", 9: "STEP9_SELECTIVE_RESTORATION", 10: "STEP10_PACKAGING"}


def struct(ddl: str) -> T.StructType:
    """A StructType from a column list."""
    out = T.StructType()
    depth, start = 0, 0
    for i, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, kind = ddl[start:i].strip().split(" ", 1)
            out.add(name, T.DataType.fromDDL(kind))
            start = i + 1
    return out


def report_schema(step: int) -> T.StructType:
    """Schema of the report of step 2 to 7, each the one before plus its own columns."""
    parts = [STEP2, STEP3_NEW, STEP4_NEW, STEP5_NEW, STEP6_NEW, STEP7_NEW][: step - 1]
    return struct(", ".join(parts))


def with_columns_once(columns: list[str], new: list[str]) -> list[str]:
    """``columns`` and then those of ``new`` that are not among them yet, order kept."""
    return columns + [c for c in new if c not in columns]
