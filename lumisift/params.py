"""Default parameters of the steps, as frozen dataclasses; every operator takes one or single values."""

from __future__ import annotations

from dataclasses import dataclass, field


# Thresholds and quotas by shot type and pose bucket.
BASE_THRESHOLDS = {"CLOSE_UP": 0.62, "UPPER_BODY": 0.58, "FULL_BODY": 0.52}
POSE_MODIFIERS = {"FRONT": 0.00, "LOOKING_DOWN": -0.04, "LOOKING_UP": -0.04, "LEFT_3Q": -0.05, "RIGHT_3Q": -0.05, "LEFT_PROFILE": -0.10, "RIGHT_PROFILE": -0.10, "EXTREME_POSE": -0.12}
SHOT_MIN = {"CLOSE_UP": 10, "UPPER_BODY": 25, "FULL_BODY": 18}
SHOT_MAX = {"CLOSE_UP": 14, "UPPER_BODY": 35, "FULL_BODY": 25}
POSE_MIN = {"FRONT": 15, "LEFT_3Q": 12, "RIGHT_3Q": 12, "LOOKING_DOWN": 6, "RIGHT_PROFILE": 3, "LEFT_PROFILE": 1, "OTHER": 1}
POSE_MAX = {"FRONT": 22, "LEFT_3Q": 20, "RIGHT_3Q": 20, "LOOKING_DOWN": 12, "RIGHT_PROFILE": 3, "LEFT_PROFILE": 1, "OTHER": 2}
REVIEW_SHARES = {"CLOSE_UP": 18.0, "UPPER_BODY": 62.0, "FULL_BODY": 20.0}


@dataclass(frozen=True)
class ExtractParams:
    num_frames: int = 50
    trim_start: float = 0.5
    trim_end: float = 0.5
    fallback_share: float = 0.05
    video_suffixes: tuple[str, ...] = ("mp4", "mov", "mkv", "avi", "webm", "m4v")
    image_suffixes: tuple[str, ...] = ("png", "jpg", "jpeg", "webp")


@dataclass(frozen=True)
class GateParams:
    close_up_area: float = 0.12
    full_body_area: float = 0.04
    min_global_laplacian: float = 25.0
    min_face_laplacian: float = 50.0
    min_source_short_edge_fullbody: int = 720
    min_face_dim_close_up: int = 140
    min_face_dim_upper_body: int = 110
    min_face_dim_full_body: int = 80
    min_visibility: float = 70.0
    max_central_gradient: float = 65.0
    min_eye_sharpness: float = 1.60
    min_skin_texture_close_up: float = 0.050
    min_skin_texture_upper_body: float = 0.035
    max_plasticity_ratio: float = 45.0
    min_brightness: float = 95.0
    backlit_brightness: float = 105.0
    min_backlit_ratio: float = 0.65
    min_single_eye: float = 0.070
    min_mean_eye: float = 0.080
    max_eye_asymmetry: float = 2.20
    laplacian_weight: float = 0.5
    tenengrad_weight: float = 0.5
    skip_beauty_filter: bool = False


@dataclass(frozen=True)
class PoseParams:
    front_yaw: float = 15.0
    three_quarter_yaw: float = 42.0
    looking_pitch: float = 20.0
    extreme_pitch: float = 35.0
    extreme_roll: float = 35.0


@dataclass(frozen=True)
class DedupParams:
    angle: float = 12.0
    time_window: int = 6
    near_hash: int = 14
    phash: int = 10
    strict_angle: float = 8.0


@dataclass(frozen=True)
class IdentityParams:
    base: dict = field(default_factory=lambda: dict(BASE_THRESHOLDS))
    base_default: float = 0.58
    modifier: dict = field(default_factory=lambda: dict(POSE_MODIFIERS))
    modifier_default: float = -0.04
    wide_yaw: float = 50.0
    wide_yaw_relief: float = 0.03
    floor: float = 0.45
    review_margin: float = 0.05
    references: int = 20


@dataclass(frozen=True)
class SelectionParams:
    target: int = 65
    max_scene_burst: int = 8
    max_reference_burst: int = 15
    shot_min: dict = field(default_factory=lambda: dict(SHOT_MIN))
    shot_max: dict = field(default_factory=lambda: dict(SHOT_MAX))
    pose_min: dict = field(default_factory=lambda: dict(POSE_MIN))
    pose_max: dict = field(default_factory=lambda: dict(POSE_MAX))
    unknown_max: int = 999


@dataclass(frozen=True)
class ReviewParams:
    target_count: int = 45
    target_shares: dict = field(default_factory=lambda: dict(REVIEW_SHARES))


@dataclass(frozen=True)
class RestorationParams:
    max_dimension: int = 190
    max_eye_sharpness: float = 2.0
    fidelity_weight: float = 0.80
    min_similarity: float = 0.60
    max_loss: float = 0.08
    min_fidelity: float = 0.82


@dataclass(frozen=True)
class PackagingParams:
    trigger: str = "character"
    multiple: int = 16


def pipeline_config() -> dict[str, object]:
    """All defaults by step, for a configuration report."""
    return {"extract": ExtractParams(), "gate": GateParams(), "pose": PoseParams(), "dedup": DedupParams(), "identity": IdentityParams(), "selection": SelectionParams(), "review": ReviewParams(), "restoration": RestorationParams(), "packaging": PackagingParams()}
