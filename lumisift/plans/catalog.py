"""Queries over the driver's tables, one or more for every operator; the SQL that must give the same rows is in :mod:`.oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import captions, kernels, names
from ..functions.math import align_up_down, hamming, quantised, sign_hash
from ..functions.spelling import base_name, posix_path
from ..operators import dedup, gate, lookup, merge, pose, ranks, reports, sampling, select, vectors
from ..params import DedupParams, ExtractParams, SelectionParams
from ..sources import environment, files, sinks
from ..sources.tables import table
from ..streaming.incremental import event_bursts
from . import pipeline
from .oracles import oracle_sql

__all__ = ["oracle_sql", "queries"]

#: Attribute phrases given to rows by their number, in place of a classifier's.
PHRASES = {
    "expression": ["calm neutral expression", "subtle smile", "focused look"],
    "clothing": ["wearing a denim jacket", "wearing a knitted sweater"],
    "hair": ["short hair", "loose hair", "hair tied back"],
    "bg": ["plain wall", "city street"],
    "lighting": ["soft daylight", "warm lamp light", "overcast sky"],
}


def _step(n: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: table(spark, d, f"step{n}_dataset_report")


step3, step4, step5, step6, step7 = (_step(n) for n in range(3, 8))


def _one(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


# Gate

def gate_rows(spark, d):
    return gate.apply_gate(step3(spark, d)).select("seq", F.concat_ws(";", "face_gate_reason").alias("reasons"), "face_eligible", "face_gate_category")


def gate_category_counts(spark, d):
    return reports.counts_with_share(gate.apply_gate(step3(spark, d)), "face_gate_category")


def gate_reasons_exploded(spark, d):
    rows = gate.apply_gate(step3(spark, d)).select(F.explode("face_gate_reason").alias("reason"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def gate_funnel(spark, d):
    r = F.col("face_gate_reason")
    flags = {"measured": ~F.array_contains(r, "analysis_error"), "one_face": ~F.arrays_overlap(r, F.array(F.lit("no_face"), F.lit("multiple_faces"))), "sharp": ~F.arrays_overlap(r, F.array(F.lit("global_blurry"), F.lit("face_blurry"))), "eligible": F.size(r) == 0}
    return reports.flag_funnel(gate.apply_gate(step3(spark, d)), flags)


def shot_types(spark, d):
    area = F.col("face_area_ratio")
    return step3(spark, d).select("seq", gate.shot_type(F.when(~F.isnan(area), area)).alias("shot"))


def eye_validity(spark, d):
    left, right = (F.when(~F.isnan(c), F.col(c)) for c in ("left_eye_presence_ratio", "right_eye_presence_ratio"))
    return step3(spark, d).select("seq", gate.eyes_valid(left, right).alias("valid"))


def beauty_flag(spark, d):
    rows = step3(spark, d).select("seq", "shot_type", "facemesh_detected", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("skin_texture_score", "plasticity_ratio")])
    return rows.select("seq", gate.beauty_filter(F.col("shot_type"), F.col("skin_texture_score"), F.col("plasticity_ratio"), F.col("facemesh_detected")).alias("flag"))


def visibility_score(spark, d):
    c = F.col
    edge = (c("face_bbox_x") <= 1) | (c("face_bbox_y") <= 1) | (c("face_bbox_x") + c("face_bbox_width") >= c("width") - 1) | (c("face_bbox_y") + c("face_bbox_height") >= c("height") - 1)
    num = {x: F.when(~F.isnan(x), c(x)) for x in ("eye_ratio_left", "eye_ratio_right", "eye_brightness_ratio", "eye_texture_ratio")}
    v = gate.visibility_signals((F.pmod("seq", F.lit(50)) + 50) / 100.0, F.pmod("seq", F.lit(5)), *num.values(), edge, c("facemesh_detected"), (c("face_bbox_width") > 0) & (c("face_bbox_height") > 0))
    return step3(spark, d).select("seq", v.alias("v")).select("seq", "v.score", "v.level", "v.occluded", F.concat_ws(";", "v.signals").alias("signals"))


# Ranks

def dense_percentile(spark, d):
    rows = step3(spark, d).filter("status = 'ok'").select("seq", "laplacian_score")
    return ranks.dense_percentile(rows, "laplacian_score", "pct").select("seq", "pct")


def midrank_percentile(spark, d):
    rows = step3(spark, d).filter("face_count = 1 and face_gate_status = 'ok'").select("seq", "face_laplacian_score")
    return ranks.midrank_percentile(rows, "face_laplacian_score", "pct").select("seq", "pct")


def sharpness_score(spark, d):
    rows = step3(spark, d).filter("face_count = 1 and face_gate_status = 'ok'").select("seq", "face_laplacian_score", "face_tenengrad_score")
    both = ranks.midrank_percentile(rows, "face_laplacian_score", "a", face_tenengrad_score="b")
    return both.select("seq", (F.col("a") * 0.5 + F.col("b") * 0.5).alias("score"))


def quality_rank(spark, d):
    rows = step3(spark, d).filter("status = 'ok' and laplacian_score is not null and tenengrad_score is not null and not isnan(laplacian_score) and not isnan(tenengrad_score)").select("seq", "laplacian_score", "tenengrad_score")
    both = ranks.dense_percentile(rows, "laplacian_score", "a", tenengrad_score="b").select("seq", (F.col("a") + F.col("b")).alias("s"))
    return ranks.global_row_number(both, [-F.col("s"), F.col("seq")], "quality_rank").select("seq", "quality_rank")


def image_stats_by_scene(spark, d):
    rows = step3(spark, d).withColumn("scene", names.scene_of(F.col("filename")))
    return reports.statistics_by(rows, "scene", "brightness_mean", 100.0, 150.0)


def event_stats_by_user(spark, d):
    return reports.statistics_by(table(spark, d, "events"), "user_id", "value", 10.0, 90.0)


def summary_stats(spark, d):
    return reports.summary_text(step3(spark, d), "face_brightness_mean")


def primary_face(spark, d):
    rows = step3(spark, d).select("frame_id", "seq", "face_bbox_width", "face_bbox_height")
    return ranks.primary_box(rows, ["frame_id"], "face_bbox_width", "face_bbox_height", "seq").select("frame_id", "seq", "box_area")


def nearest_face(spark, d):
    rows = step3(spark, d).select("frame_id", "seq", "face_bbox_x", "face_bbox_y", (F.col("width") / 2).alias("cx"), (F.col("height") / 2).alias("cy"))
    return ranks.nearest_point(rows, ["frame_id"], "face_bbox_x", "face_bbox_y", F.col("cx"), F.col("cy"), "seq").select("frame_id", "seq", "gap")


def first_rows(spark, d):
    """The feature itself is the limit: the first 100 rows by number."""
    return ranks.first_n(step4(spark, d).select("seq", "frame_id"), "seq", 100)


# Scenes, poses, names

def scene_parse(spark, d):
    f = F.col("filename")
    return step4(spark, d).select("seq", names.scene_of(f).alias("scene"), names.temporal_index(f).alias("idx"))


def path_resolution(spark, d):
    return step5(spark, d).select("seq", names.safe_path(F.col("group_best")).alias("safe"), names.suffix(F.col("group_best")).alias("ext"))


def resolve_sources(spark, d):
    """Names looked up in two listings, the report of step 3 and then that of step 4."""
    roots = [step3(spark, d).select(posix_path(F.col("filename")).alias("filename"), F.concat(F.lit("a/"), posix_path(F.col("filename"))).alias("path")), step4(spark, d).select(posix_path(F.col("filename")).alias("filename"), F.concat(F.lit("b/"), posix_path(F.col("filename"))).alias("path"))]
    return files.resolve(step5(spark, d).select("seq", "group_best"), "group_best", roots).select("seq", "source")


def pose_buckets(spark, d):
    return step4(spark, d).select("seq", pose.pose_bucket(F.col("pose_yaw"), pose.fold_pitch(F.col("pose_pitch")), F.col("pose_roll")).alias("bucket"))


def pose_distribution(spark, d):
    return pose.bucket_shares(step4(spark, d).filter("pose_bucket is not null"), "pose_bucket")


def top_pose_clusters(spark, d):
    return pose.top_clusters(step4(spark, d), "pose_cluster_key", "seq")


def equidistant_sampling(spark, d):
    return sampling.frame_plan(table(spark, d, "step1_extract_report").select("video", "duration_sec").distinct())


def single_frame_sampling(spark, d):
    return sampling.frame_plan(table(spark, d, "step1_extract_report").select("video", "duration_sec").distinct(), p=ExtractParams(num_frames=1))


def skip_existing(spark, d):
    planned = equidistant_sampling(spark, d).select("frame")
    return merge.skip_existing(planned, step3(spark, d).select(base_name(F.col("filename")).alias("frame")), "frame")


def extract_summary(spark, d):
    return sampling.extract_summary(equidistant_sampling(spark, d), step3(spark, d).select(base_name(F.col("filename")).alias("frame")))


def status_counts(spark, d):
    return step3(spark, d).agg(F.count_if(F.col("status") == "ok").alias("succeeded"), F.count_if(F.coalesce(F.col("status") != "ok", F.lit(True))).alias("failed"))


def align16(spark, d):
    return table(spark, d, "part").select("p_partkey", align_up_down(F.col("p_size") * 37).alias("aligned"))


def _candidates(spark, d):
    rows = step7(spark, d).filter("candidate_selected and lora_candidate_score is not null and candidate_rank is not null and not isnan(lora_candidate_score)")
    return rows.withColumn("shot_type", F.coalesce("shot_type", F.lit("UPPER_BODY"))).withColumn("pose_bucket", F.coalesce("pose_bucket", F.lit("FRONT"))).withColumn("name", names.candidate_name(F.col("candidate_rank"), F.col("lora_candidate_score"), F.col("shot_type"), F.col("pose_bucket"), base_name(F.col("filename"))))


def candidate_names(spark, d):
    return _candidates(spark, d).select("seq", "name")


def packaged_names(spark, d):
    """Numbers follow the sorted names of all candidates, also of those that are then left out."""
    numbered = ranks.global_row_number(_candidates(spark, d).select("seq", "name", "width"), [F.col("name"), F.col("seq")], "idx")
    return numbered.filter("width is not null").select("seq", names.packaged_name("character", F.col("idx")).alias("final_filename"))


def ranked_layouts(spark, d):
    return sinks.ranked_candidates(_candidates(spark, d).withColumn("candidate_selected", F.lit(True)))


def cluster_review_names(spark, d):
    return sinks.cluster_review(step5(spark, d))


def representative_names(spark, d):
    return sinks.representatives(step5(spark, d))


def name_classes(spark, d):
    return files.name_columns(_candidates(spark, d).select("seq", F.col("name").alias("filename"))).select("seq", "shot_type", "pose_bucket")


def review_ratio(spark, d):
    return reports.ratio_against_target(files.name_columns(_candidates(spark, d).select(F.col("name").alias("filename"))), "shot_type", {"CLOSE_UP": 18.0, "UPPER_BODY": 62.0, "FULL_BODY": 20.0})


# Similarity

def similarities(spark, d):
    s = vectors.similarities(table(spark, d, "embeddings"), "label", "vec_id", "embedding")
    return s.select("vec_id", quantised(F.col("similarity_mean"), 4).alias("mean_e4"), quantised(F.col("similarity_max"), 4).alias("max_e4"))


def hash_hamming(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "label", sign_hash(F.col("embedding")).alias("h"))
    first = vectors.reference_bank(v, "label", "vec_id", 1).select("label", F.col("h").alias("h0"))
    return v.join(first, "label").select("vec_id", hamming(F.col("h"), F.col("h0")).alias("distance"))


def _thresholds(spark, d):
    sim, yaw = (F.when(~F.isnan(c), F.col(c)) for c in ("identity_similarity_mean", "pose_yaw"))
    t = pose.dynamic_threshold(F.col("shot_type"), F.col("pose_bucket"), yaw)
    return step6(spark, d).select("seq", sim.alias("sim"), t.alias("threshold"))


def identity_gate(spark, d):
    return _thresholds(spark, d).select("seq", quantised(F.col("threshold"), 4).alias("threshold_e4"), pose.similarity_class(F.col("sim"), F.col("threshold")).alias("identity_class"))


def identity_shares(spark, d):
    return reports.class_shares(identity_gate(spark, d), "identity_class", ["PASSED", "REVIEW", "REJECT_IDENTITY"])


def identity_rank(spark, d):
    passed = _thresholds(spark, d).filter("sim >= threshold")
    return ranks.global_row_number(passed, [-F.col("sim"), F.col("seq")], "identity_rank").select("seq", "identity_rank")


# Duplicates

def _dup_frames(spark, d):
    """Latest step-5 row of each frame with what the duplicate rule compares."""
    rows = step5(spark, d).groupBy("frame_id").agg(F.max_by(F.struct("seq", "filename", "shot_type", "pose_yaw", "pose_pitch", "global_hash", "face_hash", "face_quality_score"), F.struct("reported_at", "seq")).alias("r")).select("r.*")
    f = F.col("filename")
    num = lambda c: F.when(~F.isnan(c), F.col(c))
    return rows.select("seq", F.lower(names.scene_of(f)).alias("scene"), F.col("shot_type").alias("shot"), names.temporal_index(f).alias("t"), num("pose_yaw").alias("yaw"), num("pose_pitch").alias("pitch"), F.col("global_hash").alias("gh"), F.col("face_hash").alias("fh"), "filename", F.coalesce(num("face_quality_score"), F.lit(0.0)).alias("quality"))


def dup_links(spark, d):
    return dedup.duplicate_links(_dup_frames(spark, d))


def dup_links_strict(spark, d):
    return dedup.duplicate_links(_dup_frames(spark, d), DedupParams(angle=4.0, time_window=2, near_hash=6, phash=4, strict_angle=2.0))


def dup_clusters(spark, d):
    rows = _dup_frames(spark, d)
    out = dedup.clusters(rows, dedup.duplicate_links(rows))
    return out.withColumn("angle_e4", quantised(F.col("angle_distance_to_group_best"), 4)).drop("angle_distance_to_group_best")


def dup_summary(spark, d):
    return dedup.duplicate_summary(dup_clusters(spark, d))


# Selection

def face_quality_scores(spark, d):
    return step5(spark, d).select("seq", quantised(select.quality_score(), 4).alias("score_e4"))


def candidate_scores(spark, d):
    return step7(spark, d).select("seq", quantised(select.candidate_score(), 4).alias("score_e4"), select.score_reason().alias("reason"))


def _pool(spark, d):
    rows = step7(spark, d).filter("identity_passed")
    return rows.select("seq", F.lower(names.scene_of(F.col("filename"))).alias("scene"), F.col("shot_type").alias("shot"), F.col("pose_bucket").alias("pose"), select.candidate_score().alias("score"))


def quota_selection(spark, d):
    return select.select_by_quota(_pool(spark, d)).select("seq", "quota_cell", "quota_status", "candidate_selected", "candidate_rank")


def quota_distribution(spark, d):
    p = SelectionParams()
    return select.quota_distribution(step7(spark, d), "shot_type", p.shot_min, p.shot_max)


def selected_scenes(spark, d):
    return step7(spark, d).filter("candidate_selected").agg(F.countDistinct("scene_group").alias("scenes"))


def scene_burst_cap(spark, d):
    return step4(spark, d).select("scene_group").distinct().select("scene_group", select.scene_cap(F.col("scene_group")).alias("cap"))


# Merging and lookups

def upsert_merge(spark, d):
    cols = ["filename", "seq", "run_id", "shot_type"]
    rows = step3(spark, d).select(*cols)
    return merge.upsert(rows.filter("run_id >= 500"), rows.filter("run_id < 500"), "filename", "seq").select("filename", "seq", "run_id", "shot_type", F.col("__part").alias("part"))


def metadata_join_basename(spark, d):
    right = step4(spark, d).select(base_name(F.col("filename")).alias("base"), F.col("seq").alias("report_seq"), "shot_type")
    left = step5(spark, d).select("seq", base_name(F.col("group_best")).alias("base"))
    return lookup.lookup_join(left, right, "base", "report_seq", {"shot_type": "UPPER_BODY"}).select("seq", "report_seq", "shot_type")


def metadata_join_substring(spark, d):
    keys = table(spark, d, "step1_extract_report").select("output_folder", "video")
    return lookup.substring_join(step4(spark, d).select("seq", "filename"), "filename", keys, "output_folder", "video").select("seq", "output_folder")


def first_report_row(spark, d):
    """First report row of each picture, by base name."""
    rows = step3(spark, d).select(base_name(F.col("filename")).alias("base"), "seq", "shot_type")
    return lookup.first_wins(rows, "base", "seq")


def semi_anti_counts(spark, d):
    frames, chosen = step3(spark, d).select("frame_id"), step7(spark, d).filter("candidate_selected").select("frame_id")
    a = lookup.semi(frames, chosen, "frame_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("semi").alias("side"), "n")
    return a.unionByName(lookup.anti(frames, chosen, "frame_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("anti").alias("side"), "n"))


def eligible_rows(spark, d):
    """Equality and membership filters in a row: eligible, kept by the duplicate step, passed."""
    rows = step7(spark, d)
    kept = lookup.condition_rows(lookup.eligible(rows), F.col("duplicate_status").isin("representative", "unique"))
    return lookup.condition_rows(kept, F.col("identity_passed")).select("seq")


# Restoration and packaging

def _restored(spark, d):
    """Step 9 as shipped, over step 7 with similarities and a fidelity made from its columns, NaN as missing."""
    num = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    rows = step7(spark, d).withColumn("eye_sharpness", num("eye_sharpness")).withColumns({"identity_sim_before": F.coalesce(num("identity_similarity_mean"), F.lit(0.0)), "identity_sim_after": F.coalesce(num("identity_similarity_max"), F.lit(0.0)), "fidelity_to_orig": F.pmod("seq", F.lit(40)) / 100.0 + 0.6})
    return pipeline.restore_step(rows, keep=("seq",))


def restoration_plan(spark, d):
    return _restored(spark, d).select("seq", (F.col("restoration_status") != "untouched_raw_camera").alias("wanted"))


def _decided(spark, d):
    return _restored(spark, d).withColumn("wanted", F.col("restoration_status") != "untouched_raw_camera")


def rollback_decision(spark, d):
    return _decided(spark, d).select("seq", "restoration_status")


def status_lookup_default(spark, d):
    right = _decided(spark, d).filter("wanted").select(base_name(F.col("filename")).alias("base"), F.col("seq").alias("rseq"), "restoration_status")
    left = step4(spark, d).select("seq", base_name(F.col("filename")).alias("base"))
    return lookup.lookup_join(left, right, "base", "rseq", {"restoration_status": "untouched_raw_camera"}).select("seq", "restoration_status")


def _packaged(spark, d):
    attributes = {k: F.element_at(F.array(*map(F.lit, v)), (F.pmod("seq", F.lit(len(v))) + 1).cast("int")) for k, v in PHRASES.items()}
    rows = _candidates(spark, d)
    return rows.select(
        "seq", "shot_type", "pose_bucket", F.concat(F.lit("character_"), F.col("seq").cast("string"), F.lit(".png")).alias("final_filename"),
        captions.caption("character", F.col("shot_type"), F.col("pose_bucket"), attributes).alias("flux_caption"), captions.tags("character", F.col("shot_type"), F.col("pose_bucket"), attributes).alias("tags_caption"),
        align_up_down(F.col("width")).alias("aligned_width"), align_up_down(F.col("height")).alias("aligned_height"), F.lit("untouched_raw_camera").alias("restoration_status"),
    )


def caption_text(spark, d):
    return _packaged(spark, d).select("seq", F.col("flux_caption").alias("caption"))


def caption_tags(spark, d):
    return _packaged(spark, d).select("seq", F.col("tags_caption").alias("tags"))


def metadata_jsonl(spark, d):
    return sinks.metadata_json(_packaged(spark, d).filter("aligned_width is not null and aligned_height is not null"))


def caption_files(spark, d):
    return sinks.caption_files(_packaged(spark, d))


def training_guide(spark, d):
    return sinks.training_guide(_packaged(spark, d))


# Parsing, kernels, streams, environment

def safe_parse(spark, d):
    """Values that may not parse keep their row: the number, or the message."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    odd = F.col("event_type").try_cast("int")
    return table(spark, d, "events").select("event_id", k.alias("k"), F.when(odd.isNull(), F.concat(F.lit("not a number: "), F.col("event_type"))).alias("error"))


def bursts(spark, d):
    return event_bursts(table(spark, d, "events")).select("user_id", "burst_start", "events", quantised(F.col("total"), 2).alias("total_e2"))


def pixel_metrics(spark, d):
    """The technical metrics of 8 x 8 patches made of embeddings."""
    px = F.transform("embedding", lambda x: F.least(F.greatest(x.cast("double") * 400 + 128, F.lit(0.0)), F.lit(255.0)))
    return table(spark, d, "embeddings").select("vec_id", kernels.technical_metrics_udf(px, 8).alias("m")).select("vec_id", "m.*")


def identity_crops(spark, d):
    """The crop of each face with its margin, or the upper middle where no box is, from the report's boxes."""
    c = lambda x: F.coalesce(F.col(x), F.lit(0))
    rows = step3(spark, d).filter("width is not null and height is not null")
    return rows.select("seq", kernels.identity_box_column(c("face_bbox_x"), c("face_bbox_y"), c("face_bbox_width"), c("face_bbox_height"), F.col("width"), F.col("height")).alias("b")).select("seq", "b.*")


def face_measures(spark, d):
    """The measures of the face on 64 x 64 pictures in which each embedding is a pattern, with a fixed mesh; as thousandths."""
    at = {33: (0.25, 0.35), 133: (0.42, 0.35), 263: (0.75, 0.36), 362: (0.58, 0.35), 61: (0.38, 0.72), 291: (0.62, 0.72), 50: (0.3, 0.55), 280: (0.7, 0.55), 10: (0.5, 0.1), 234: (0.1, 0.5), 152: (0.5, 0.9), 454: (0.9, 0.5)}
    mesh = F.array(*[F.array(*[F.lit(float(x)) for x in at.get(i, (0.5, 0.5))]) for i in range(455)])
    pixel = lambda scale, shift: F.transform(F.sequence(F.lit(0), F.lit(4095)), lambda i: F.least(F.greatest(F.try_element_at("embedding", ((F.pmod(i * 7 + F.floor(i / 64) * 3, F.lit(64))) + 1).cast("int")).cast("double") * scale + shift, F.lit(0.0)), F.lit(255.0)))
    m = kernels.face_measures_udf(pixel(400, 128), pixel(300, 60), pixel(500, 110), F.lit(64), mesh, F.array(*map(F.lit, (8, 8, 48, 48))))
    rows = table(spark, d, "embeddings").select("vec_id", m.alias("m")).select("vec_id", "m.*")
    return rows.select("vec_id", *[quantised(F.col(f), 3).alias(f"{f}_e3") for f in kernels.FACE_FIELDS], "error")


def head_pose(spark, d):
    """The angles of step 4 found again from face-mesh points: a model head is turned by them, seen by a camera, and its pose solved; angles that turn the face away are no case."""
    yaw, pitch, roll = (F.radians(F.col(c)) for c in ("pose_yaw", "pose_pitch", "pose_roll"))
    sx, sy, sz, cx, cy, cz = *(F.sin(a) for a in (pitch, yaw, roll)), *(F.cos(a) for a in (pitch, yaw, roll))
    turn = ((cz * cy, cz * sy * sx - sz * cx, cz * sy * cx + sz * sx), (sz * cy, sz * sy * sx + cz * cx, sz * sy * cx - cz * sx), (-sy, cy * sx, cy * cx))
    seen = {}
    for i, point in zip(kernels.POSE_POINTS, kernels.MODEL_HEAD):
        x, y, z = (sum((r * v for r, v in zip(row, point)), F.lit(shift)) for row, shift in zip(turn, (20.0, -30.0, 2000.0)))
        seen[i] = F.array(x / z + 0.5, y / z + 0.5)
    mesh = F.array(*[seen.get(i, F.array(F.lit(0.5), F.lit(0.5))) for i in range(max(seen) + 1)])
    rows = step4(spark, d).filter("abs(pose_yaw) <= 85 and abs(pose_pitch) <= 85 and abs(pose_roll) <= 175")
    got = rows.select("seq", kernels.head_pose_udf(mesh, F.lit(1000), F.lit(1000)).alias("p"))
    return got.select("seq", *[quantised(F.col(f"p.{c}") + 1e-4, 2).alias(f"{c}_e2") for c in ("pose_yaw", "pose_pitch", "pose_roll")], "p.pose_error")


def clip_labels(spark, d):
    """The phrases of the greatest scores, taken from the leading elements of each embedding."""
    scores = {a: F.slice("embedding", 1 + 8 * i, len(v)) for i, (a, v) in enumerate(captions.PROMPTS.items())}
    return table(spark, d, "embeddings").select("vec_id", *[v.alias(a) for a, v in captions.best_attributes(scores).items()])


def configuration(spark, d):
    return environment.configuration(spark)


def healthcheck(spark, d):
    return environment.healthcheck(spark)


_HIDDEN = {"table", "oracle_sql", "queries", "base_name", "posix_path", "align_up_down", "hamming", "quantised", "sign_hash", "event_bursts"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    return {k: v for k, v in globals().items() if callable(v) and not k.startswith("_") and k not in _HIDDEN and getattr(v, "__module__", "") == __name__ and not k.startswith("step")}
