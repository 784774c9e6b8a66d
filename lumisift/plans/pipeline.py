"""The steps as functions from report to report. Measured columns (metrics, landmarks' results, angles, hashes, similarities) are inputs.

Each report has ``seq`` (row order) and ``filename``; a step keeps all columns, recomputes its own and stamps ``step_name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import captions, names
from ..functions.math import align_up_down
from ..functions.spelling import base_name
from ..operators import dedup, gate, lookup, pose, ranks, select
from ..params import DedupParams, GateParams, IdentityParams, PackagingParams, PoseParams, RestorationParams, SelectionParams
from ..schemas import STEP5_NEW, STEP6_NEW, STEP7_NEW, STEP9, STEP10, STEP_NAMES, struct


def _stamp(rows: DataFrame, step: int) -> DataFrame:
    return rows.withColumn("step_name", F.lit(STEP_NAMES[step]))


def _fresh(rows: DataFrame, ddl: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Without a step's own columns, so that none survives a rerun."""
    return rows.drop(*[f.name for f in struct(ddl).fields if f.name not in keep])


def _attach(rows: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    return rows.drop(*columns).join(found.select("seq", *columns), "seq", "left")


def metrics_step(report: DataFrame) -> DataFrame:
    """Relative ranks of the technical metrics among rows with status ok."""
    own = ["laplacian_percentile", "tenengrad_percentile", "quality_rank"]
    ok = report.filter("status = 'ok' and laplacian_score is not null and tenengrad_score is not null").select("seq", "laplacian_score", "tenengrad_score")
    both = ranks.dense_percentile(ok, "laplacian_score", own[0], tenengrad_score=own[1])
    ranked = ranks.global_row_number(both.select("seq", own[0], own[1]).withColumn("__sum", F.col(own[0]) + F.col(own[1])), [-F.col("__sum"), F.col("seq")], own[2])
    return _stamp(_attach(report, ranked.withColumn(own[2], F.col(own[2]).cast("int")), own), 2)


def gate_step(report: DataFrame, p: GateParams = GateParams(), as_on_disk: bool = False) -> DataFrame:
    """Shot type, eye and skin flags, face percentiles, reasons, eligibility and category; ``as_on_disk`` gates on the decimals a CSV keeps."""
    c = F.col
    rows = report.withColumn("shot_type", gate.shot_type(c("face_area_ratio"), p)).withColumn("eye_presence_valid", gate.eyes_valid(c("left_eye_presence_ratio"), c("right_eye_presence_ratio"), p))
    rows = rows.withColumn("beauty_filter_detected", gate.beauty_filter(c("shot_type"), c("skin_texture_score"), c("plasticity_ratio"), c("facemesh_detected"), p))
    own = ["face_laplacian_percentile", "face_tenengrad_percentile"]
    one = rows.filter("face_count = 1 and face_gate_status = 'ok'").select("seq", "face_laplacian_score", "face_tenengrad_score")
    ranked = ranks.midrank_percentile(one, "face_laplacian_score", own[0], face_tenengrad_score=own[1])
    rows = _attach(rows, ranked, own)
    rows = rows.withColumn("face_sharpness_score", (c(own[0]) * p.laplacian_weight + c(own[1]) * p.tenengrad_weight) / (p.laplacian_weight + p.tenengrad_weight))
    return _stamp(gate.apply_gate(gate.rounded_inputs(rows) if as_on_disk else rows, p), 3)


def pose_step(report: DataFrame, p: PoseParams = PoseParams(), all_images: bool = False) -> DataFrame:
    """Bucket, cluster key, scene and index of eligible rows (or of all with a face); a missing angle is a failed estimate."""
    target = F.coalesce(F.col("face_detected") if all_images else F.col("face_eligible"), F.lit(False))
    bucket = pose.pose_bucket(F.col("pose_yaw"), pose.fold_pitch(F.col("pose_pitch")), F.col("pose_roll"), p)
    rows = report.withColumn("pose_bucket", F.when(target, F.coalesce(bucket, F.lit("ESTIMATION_FAILED"))))
    rows = rows.withColumn("pose_status", F.when(target, F.when(bucket.isNull(), "error").otherwise("ok")))
    rows = rows.withColumn("pose_cluster_key", F.when(target, F.concat_ws("_", F.coalesce("shot_type", F.lit("UPPER_BODY")), "pose_bucket")))
    return _stamp(rows.withColumn("scene_group", names.scene_of(F.col("filename"))).withColumn("temporal_index", names.temporal_index(F.col("filename"))), 4)


def dedup_step(report: DataFrame, p: DedupParams = DedupParams()) -> DataFrame:
    """Clusters of eligible rows with a hash, their best rows and the distances to them."""
    rows = _fresh(report, STEP5_NEW).withColumn("face_quality_score", F.when(F.col("face_eligible"), F.floor(select.quality_score() * 10 + 0.5) / 10))
    frames = rows.filter("face_eligible").select("seq", F.col("scene_group").alias("scene"), F.col("shot_type").alias("shot"), F.col("temporal_index").alias("t"), F.col("pose_yaw").alias("yaw"), F.col("pose_pitch").alias("pitch"), F.col("global_hash").alias("gh"), F.col("face_hash").alias("fh"), "filename", F.col("face_quality_score").alias("quality"))
    found = dedup.clusters(frames, dedup.duplicate_links(frames, p))
    own = [c for c in found.columns if c != "seq"]
    error = F.when(F.col("face_eligible") & F.col("duplicate_status").isNull(), "no hash")
    joined = _attach(rows, found, own).withColumn("duplicate_error", error)
    return _stamp(joined.withColumn("duplicate_status", F.when(F.col("duplicate_error").isNotNull(), "error").otherwise(F.col("duplicate_status"))), 5)


def identity_step(report: DataFrame, p: IdentityParams = IdentityParams(), all_eligible: bool = False) -> DataFrame:
    """Threshold, class, pass and rank of the rows kept by the duplicate step, from the measured similarities."""
    target = F.coalesce(F.col("face_eligible") if all_eligible else F.col("duplicate_status").isin("representative", "unique"), F.lit(False)) & F.col("identity_similarity_mean").isNotNull()
    threshold = pose.dynamic_threshold(F.col("shot_type"), F.col("pose_bucket"), F.col("pose_yaw"), p)
    rows = _fresh(report, STEP6_NEW, ("identity_similarity_mean", "identity_similarity_max")).withColumn("identity_threshold", F.when(target, threshold))
    rows = rows.withColumn("identity_class", pose.similarity_class(F.col("identity_similarity_mean"), F.col("identity_threshold"), p))
    rows = rows.withColumn("identity_passed", F.when(target, F.col("identity_class") == "PASSED"))
    passed = ranks.global_row_number(rows.filter("identity_passed").select("seq", "identity_similarity_mean"), [-F.col("identity_similarity_mean"), F.col("seq")], "identity_rank")
    return _stamp(_attach(rows, passed.withColumn("identity_rank", F.col("identity_rank").cast("int")), ["identity_rank"]).withColumn("identity_error", F.lit(None).cast("string")), 6)


def select_step(report: DataFrame, p: SelectionParams = SelectionParams()) -> DataFrame:
    """Scores of the passed rows and the quota selection among them."""
    rows = _fresh(report, STEP7_NEW)
    passed = F.coalesce(F.col("identity_passed"), F.lit(False))
    rows = rows.withColumn("lora_candidate_score", F.when(passed, F.floor(select.candidate_score() * 100 + 0.5) / 100)).withColumn("selection_reason", F.when(passed, select.score_reason()))
    pool = rows.filter(passed).select("seq", F.col("scene_group").alias("scene"), F.col("shot_type").alias("shot"), F.col("pose_bucket").alias("pose"), F.col("lora_candidate_score").alias("score"))
    found = select.select_by_quota(pool, p).withColumn("candidate_rank", F.col("candidate_rank").cast("int"))
    return _stamp(_attach(rows, found, ["quota_cell", "quota_status", "candidate_selected", "candidate_rank"]), 7)


def apply_review(selected: DataFrame, rejected: DataFrame) -> DataFrame:
    """Selected rows without the files a person has thrown out (``filename``)."""
    return lookup.anti(lookup.eligible(selected, "candidate_selected"), rejected, "filename")


def restore_step(selected: DataFrame, p: RestorationParams = RestorationParams(), model_loaded: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decision per picture from the measured similarities before and after and the fidelity; pictures outside the rule stay as they are. Columns to ``keep`` come first."""
    wanted = F.coalesce((F.col("shot_type") == "FULL_BODY") & ((F.coalesce("face_min_dimension", F.lit(200)) < p.max_dimension) | (F.coalesce("eye_sharpness", F.lit(2.0)) < p.max_eye_sharpness)), F.lit(False)) & F.lit(model_loaded)
    rows = selected.withColumn("delta_identity", F.col("identity_sim_after") - F.col("identity_sim_before"))
    safe = F.coalesce((F.col("identity_sim_after") >= p.min_similarity) & (F.col("delta_identity") >= -p.max_loss) & (F.col("fidelity_to_orig") >= p.min_fidelity), F.lit(False))
    rows = rows.withColumn("restoration_status", F.when(~wanted, "untouched_raw_camera").when(safe, "safely_restored").otherwise("rollback_to_original"))
    rows = rows.withColumn("restoration_reason", F.when(~wanted, "not a candidate").when(safe, F.format_string("delta %+.4f", F.col("delta_identity"))).otherwise("identity or fidelity outside the limits"))
    return _stamp(rows, 9).select(*keep, *[f.name for f in struct(STEP9).fields])


def package_step(pictures: DataFrame, report: DataFrame, restored: DataFrame, p: PackagingParams = PackagingParams()) -> DataFrame:
    """Captions and names of the final pictures: ``pictures`` has filename, width, height and the five attribute columns.

    Shot and pose come from the report row whose base name the picture's name contains, else from the name itself. Numbers follow
    the sorted names, also where a picture has no size and is left out.
    """
    keys = lookup.last_wins(report.select(base_name(F.col("filename")).alias("key"), "seq", F.col("shot_type").alias("r_shot"), F.col("pose_bucket").alias("r_pose")), "key", "seq")
    rows = ranks.global_row_number(pictures, [F.col("filename")], "idx")
    rows = lookup.substring_join(rows, "filename", keys, "key", "seq").join(keys.drop("seq"), "key", "left")
    status = restored.select(base_name(F.col("filename")).alias("base"), "seq", "restoration_status")
    rows = lookup.lookup_join(rows.withColumn("base", base_name(F.col("filename"))), status, "base", "seq", {"restoration_status": "untouched_raw_camera"})
    f = F.col("filename")
    rows = rows.withColumn("shot_type", F.coalesce("r_shot", names.shot_in_name(f, ("CLOSE_UP", "FULL_BODY"), "UPPER_BODY"))).withColumn("pose_bucket", F.coalesce("r_pose", names.pose_in_name(f)))
    attributes = {"expression": F.col("expression_desc"), "clothing": F.col("clothing_desc"), "hair": F.col("hair_desc"), "bg": F.col("bg_desc"), "lighting": F.col("lighting_desc")}
    rows = rows.filter("width is not null and height is not null").withColumns({
        "final_filename": names.packaged_name(p.trigger, F.col("idx")), "original_filename": base_name(f), "aligned_width": align_up_down(F.col("width"), p.multiple), "aligned_height": align_up_down(F.col("height"), p.multiple),
        "flux_caption": captions.caption(p.trigger, F.col("shot_type"), F.col("pose_bucket"), attributes), "tags_caption": captions.tags(p.trigger, F.col("shot_type"), F.col("pose_bucket"), attributes),
    })
    return _stamp(rows, 10).select(*[x.name for x in struct(STEP10).fields])


def run_steps(report: DataFrame, first: int = 2, last: int = 7) -> DataFrame:
    """Steps ``first`` to ``last`` in a row over a report with all measured columns."""
    for step, f in ((2, metrics_step), (3, gate_step), (4, pose_step), (5, dedup_step), (6, identity_step), (7, select_step)):
        if first <= step <= last:
            report = f(report)
    return report
