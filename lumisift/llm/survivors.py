"""Problem 3: the best representative of each duplicate group, from consistent bundles of fields."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spelling import canonical
from .reports import number, quality_score

#: Fields that are only meaningful together, and so are taken from one row.
BUNDLES = {
    "image": ("width", "height", "brightness_mean", "brightness_std", "contrast_p90_p10", "laplacian_score", "tenengrad_score"),
    "shot": ("shot_type", "face_area_ratio", "face_min_dimension", "source_short_edge", "face_bbox_x", "face_bbox_y", "face_bbox_width", "face_bbox_height"),
    "pose": ("pose_yaw", "pose_pitch", "pose_roll", "pose_bucket", "pose_cluster_key"),
    "eyes": ("eye_presence_valid", "left_eye_presence_ratio", "right_eye_presence_ratio", "eye_sharpness", "mouth_sharpness"),
    "hash": ("global_hash", "face_hash"),
}
#: Further bundles, under no constraint with others: each is taken from the most trusted row of the group, outside the search.
FREE = {
    "exposure": ("shadow_pixel_ratio", "highlight_pixel_ratio"),
    "file_rank": ("laplacian_percentile", "tenengrad_percentile", "quality_rank"),
    "face": ("face_detected", "face_count", "multiple_faces", "facemesh_detected"),
    "face_light": ("face_brightness_mean", "face_to_global_brightness_ratio", "face_central_gradient"),
    "skin": ("skin_texture_score", "plasticity_ratio", "beauty_filter_detected"),
    "face_sharpness": ("face_laplacian_score", "face_tenengrad_score", "face_laplacian_percentile", "face_tenengrad_percentile", "face_sharpness_score"),
    "visibility": ("face_visibility_score", "occlusion_detected", "occlusion_level", "face_visibility_signals", "eye_ratio_left", "eye_ratio_right", "eye_brightness_ratio", "eye_texture_ratio"),
    "gate": ("face_eligible", "face_gate_category", "face_gate_reason", "face_gate_status", "face_gate_error"),
}
#: Taken from the row of the pose; from the frame's own latest row where neither has a pose.
POSE_STATE = ("pose_status", "pose_error")
#: What names the frame or its file, from the frame's own latest row of the group.
OWN = ("seq", "reported_at", "step_name", "filename", "file_size_bytes", "temporal_index", "status", "error", "duplicate_error")
# The shot types and pose buckets that step 3 and step 4 can produce, in canonical spelling.
SHOTS = ("closeup", "upperbody", "fullbody")
POSES = ("front", "left3q", "right3q", "leftprofile", "rightprofile", "lookingup", "lookingdown", "extremepose")
#: Order in which the search fixes the bundles: those under constraints first. ``frame``, the surviving frame itself, is one of them: its trust is its score.
ORDER = ("shot", "pose", "image", "eyes", "hash", "frame")
#: Added to a score, -30 at least, so that a frame is never worth less than none.
OFFSET = 32.0


def best_bundles(options: dict[str, list[tuple]]) -> dict[str, tuple]:
    """Choose one option per bundle, of greatest total trust under the functional dependencies.

    ``options[bundle]`` holds (trust, shot, pose_shot, seq). The pose bundle's cluster key determines a shot
    type (``pose_shot``), which must be that of the shot bundle unless one of the two is unknown (``""``); a bundle may stay empty
    (trust 0). Depth-first branch and bound: options by falling trust, a branch is left when its trust
    plus the best of every open bundle cannot beat the best solution so far.
    """
    names = [b for b in ORDER if options.get(b)]
    ranked = {b: sorted(options[b], key=lambda o: (-o[0], o[3])) for b in names}
    rest = [0.0] * (len(names) + 1)
    for i in range(len(names) - 1, -1, -1):
        rest[i] = rest[i + 1] + max(0.0, ranked[names[i]][0][0])
    best_trust, best = -1.0, {}
    stack: list[tuple[int, float, str, dict]] = [(0, 0.0, "", {})]
    while stack:
        i, trust, shot, chosen = stack.pop()
        if trust + rest[i] <= best_trust:
            continue
        if i == len(names):
            best_trust, best = trust, chosen
            continue
        name = names[i]
        branches = []
        for option in ranked[name]:
            if trust + option[0] + rest[i + 1] <= best_trust:
                break
            if name == "pose" and shot and option[2] and option[2] != shot:
                continue
            branches.append((i + 1, trust + option[0], option[1] if name == "shot" else shot, {**chosen, name: option}))
        stack.append((i + 1, trust, shot, chosen))  # left empty
        stack.extend(reversed(branches))  # the most trusted is looked at first
    return best


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for run, group, frames, options in zip(pdf["run_id"], pdf["grp"], pdf["frames"], pdf["options"]):
            by: dict[str, list[tuple]] = {}
            for o in options:
                by.setdefault(o["bundle"], []).append((o["trust"], o["shot"], o["pose_shot"], o["seq"]))
            best = best_bundles(by)
            frame = best["frame"][3]
            score = next(o["score"] for o in options if o["bundle"] == "frame" and o["seq"] == frame)
            out.append((run, group, frame, score, frames, *[best[b][3] if b in best else None for b in BUNDLES]))
        yield pd.DataFrame(out, columns=["run_id", "duplicate_group", "frame_id", "face_quality_score", "frames", *[f"{b}_seq" for b in BUNDLES]]).astype({f"{b}_seq": "Int64" for b in BUNDLES})


def _known(text: Column, values: tuple[str, ...]) -> Column:
    key = canonical(text)
    return F.when(key.isin(*values), key).otherwise("")


def _filled(columns: tuple[str, ...], types: dict[str, str]) -> Column:
    """Share of the columns that have a value, NaN and blanks being none."""
    columns = tuple(c for c in columns if not c.endswith("_error"))  # an error is no value
    has = [F.col(c).isNotNull() & (~F.isnan(c) if types[c] in ("double", "float") else (canonical(F.col(c)) != "") if types[c] == "string" else F.lit(True)) for c in columns]
    return sum((F.coalesce(h, F.lit(False)).cast("double") for h in has), F.lit(0.0)) / len(columns)


def _trust(types: dict[str, str], bundles: dict[str, tuple[str, ...]] = BUNDLES) -> dict[str, Column]:
    """Trust of each bundle of a row: how complete it is, whether its own dependencies hold, how good the row's score is."""
    shot, pose = _known(F.col("shot_type"), SHOTS), _known(F.col("pose_bucket"), POSES)
    key = canonical(F.col("pose_cluster_key"))
    area = number("face_area_ratio")
    by_area = F.when(area >= 0.12, "closeup").when(area >= 0.04, "upperbody").when(area >= 0, "fullbody").otherwise("")
    dim = F.col("face_min_dimension")
    sound = {
        "image": (F.col("width") > 0) & (F.col("height") > 0),
        "shot": (shot == by_area) & dim.between(1, F.col("source_short_edge")),
        "pose": (pose != "") & key.endswith(pose) & (F.abs(number("pose_yaw")) <= 180) & (F.abs(number("pose_pitch")) <= 180),
        "eyes": (number("eye_sharpness") >= 0) & (number("mouth_sharpness") >= 0),
        "hash": F.lit(True),
        "exposure": number("shadow_pixel_ratio").between(0, 1) & number("highlight_pixel_ratio").between(0, 1),
        "file_rank": F.col("quality_rank") >= 1,
        "face": F.col("face_count") >= 0,
        "face_light": (number("face_brightness_mean") > 1) & (number("face_brightness_mean") <= 255),  # not on the scale of shares
        "skin": number("skin_texture_score") >= 0,
        "face_sharpness": (number("face_laplacian_score") >= 0) & (number("face_tenengrad_score") >= 0),
        "visibility": number("face_visibility_score") >= 0,
        "gate": (canonical(F.col("face_gate_category")) != "") & (canonical(F.col("face_gate_status")) != ""),
    }
    quality = F.coalesce((F.col("score") + 30) / 2300, F.lit(0.0))
    return {b: F.when(_filled(c, types) > 0, _filled(c, types) * 4 + F.coalesce(sound[b], F.lit(False)).cast("double") * 2 + quality) for b, c in bundles.items()}


def _members(step5: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The rows that belong to a group, with its label as ``grp`` and the possible ``score``."""
    needed = ["seq", "reported_at", "run_id", "frame_id", "duplicate_group", "face_quality_score", *columns]
    rows = step5.select(*dict.fromkeys(needed)).withColumn("grp", F.lower(F.trim("duplicate_group"))).withColumn("score", quality_score())
    return rows.filter((F.col("grp") != "") & F.col("run_id").isNotNull() & F.col("frame_id").isNotNull())


def choose_survivors(step5: DataFrame) -> DataFrame:
    """One row per duplicate group (run_id and trimmed lower-case label) of two or more frames.

    The search (:func:`best_bundles`) chooses all parts of the survivor: ``frame_id``, the frame of highest quality score, each frame's latest row of the group with a possible score
    counting, ties to the smaller frame_id, and for each bundle of dependent fields ``<bundle>_seq``, the row from which the whole bundle is taken;
    null where the group has no value for it. Groups without any possible score give no row.
    Rows without run, label or frame belong to no group. Recorded group_best and duplicate_status are not read.

    Of the options for a bundle only the most trusted (then latest) per combination of the constrained values can be part of a best solution, and
    there are at most 4 x 4 x 9 combinations; that reduction runs on the map side, so that a group with a third of all rows reaches the search as
    a short list. Of the frames the best of each combination are options.
    """
    types = dict(step5.dtypes)
    rows = _members(step5, tuple(c for b in BUNDLES.values() for c in b))
    trust = _trust(types)
    key = canonical(F.col("pose_cluster_key"))
    pose_shot = F.coalesce(*[F.when(key.startswith(s), s) for s in SHOTS], F.lit(""))
    signs = ("s_shot", "s_pose_shot", "s_pose")
    signed = rows.select("run_id", "grp", "frame_id", "seq", "reported_at", "score", _known(F.col("shot_type"), SHOTS).alias("s_shot"), pose_shot.alias("s_pose_shot"), _known(F.col("pose_bucket"), POSES).alias("s_pose"), *[trust[b].alias(f"t_{b}") for b in BUNDLES])
    place = F.struct("reported_at", "seq")
    frames = signed.groupBy("run_id", "grp", "frame_id").agg(F.max_by(F.struct("score", *signs), F.when(F.col("score").isNotNull(), place)).alias("r"))
    frames = frames.select("run_id", "grp", "frame_id", "r.score", *[F.coalesce(f"r.{s}", F.lit("")).alias(s) for s in signs])
    leaders = frames.groupBy("run_id", "grp", *signs).agg(F.count(F.lit(1)).alias("frames"), F.max(F.when(F.col("score").isNotNull(), F.struct("score", (-F.col("frame_id")).alias("f")))).alias("b"))
    option = lambda name, trust, seq, score=F.lit(None): F.struct(F.lit(name).alias("bundle"), trust.alias("trust"), F.col("s_shot").alias("shot"), F.col("s_pose_shot").alias("pose_shot"), seq.cast("bigint").alias("seq"), score.cast("double").alias("score"))
    leads = leaders.groupBy("run_id", "grp").agg(F.sum("frames").alias("frames"), F.collect_list(F.when(F.col("b").isNotNull(), option("frame", F.col("b.score") + OFFSET, -F.col("b.f"), F.col("b.score")))).alias("leads"))
    tops = signed.groupBy("run_id", "grp", *signs).agg(*[F.max(F.when(F.col(f"t_{b}").isNotNull(), F.struct(F.col(f"t_{b}").alias("trust"), "reported_at", "seq"))).alias(b) for b in BUNDLES])
    options = F.array_compact(F.array(*[F.when(F.col(b).isNotNull(), option(b, F.col(f"{b}.trust"), F.col(f"{b}.seq"))) for b in BUNDLES]))
    lists = tops.groupBy("run_id", "grp").agg(F.flatten(F.collect_list(options)).alias("options"))
    ready = leads.filter("frames >= 2 and size(leads) > 0").join(lists, ["run_id", "grp"]).select("run_id", "grp", "frames", F.concat("leads", "options").alias("options"))
    schema = f"run_id {types['run_id']}, duplicate_group string, frame_id {types['frame_id']}, face_quality_score double, frames bigint, " + ", ".join(f"{b}_seq bigint" for b in BUNDLES)
    return ready.mapInPandas(_choose, schema)


def fill_survivors(step5: DataFrame) -> DataFrame:
    """The survivors with all columns of the report, and ``frames``, fetched by ``seq`` in one pass over the reports.

    Measured fields come whole by bundle: those under constraints by :func:`choose_survivors`, each of FREE from the group's most trusted (then latest) row.
    ``scene_group`` is that of the frame's latest row that has one, else of the group's; the fields of OWN are those of the frame's latest row of the
    group. What a group's choice decides is not read but set as step 5 sets it for a representative: group_size, group_best, duplicate_status and the distances, 0.
    """
    types = dict(step5.dtypes)
    own_columns = [c for c in OWN if c in types]
    trust = _trust(types, FREE)
    rows = _members(step5, (*(c for b in FREE.values() for c in b), "scene_group", *BUNDLES["pose"]))
    place = ["reported_at", "seq"]
    scene = F.when(canonical(F.col("scene_group")) != "", F.struct(*place))
    tops = rows.groupBy("run_id", "grp").agg(F.max(scene).getField("seq").alias("__any_scene"), *[F.max(F.when(trust[b].isNotNull(), F.struct(trust[b].alias("trust"), *place))).getField("seq").alias(f"{b}_seq") for b in FREE])
    own = rows.groupBy("run_id", "grp", "frame_id").agg(F.max(F.struct(*place, (_filled(BUNDLES["pose"], types) > 0).alias("posed"))).alias("__own"), F.max(scene).getField("seq").alias("__own_scene"))
    names = ["run_id", "duplicate_group", "frame_id", "face_quality_score", "frames"]
    chosen = choose_survivors(step5).join(tops.withColumnRenamed("grp", "duplicate_group"), ["run_id", "duplicate_group"]).join(own.withColumnRenamed("grp", "duplicate_group"), ["run_id", "duplicate_group", "frame_id"])
    fields = {**BUNDLES, **FREE, "pose_state": POSE_STATE, "scene": ("scene_group",), "own": tuple(own_columns)}
    chosen = chosen.withColumn("own_seq", F.col("__own.seq")).withColumn("scene_seq", F.coalesce("__own_scene", "__any_scene")).withColumn("pose_state_seq", F.coalesce("pose_seq", F.when(~F.col("__own.posed"), F.col("__own.seq"))))
    sources = [f"{b}_seq" for b in fields]
    # One row per survivor and report row that it takes something from.
    picks = chosen.select(*names, *sources, F.explode(F.array_distinct(F.array_compact(F.array(*sources)))).alias("__pick"))
    reports = _members(step5, tuple(dict.fromkeys(c for cs in fields.values() for c in cs))).select(F.col("seq").alias("__pick"), *[F.struct(*cs).alias(f"__{b}") for b, cs in fields.items()])
    got = picks.join(reports, "__pick").groupBy(*names).agg(*[F.max(F.when(F.col(f"{b}_seq") == F.col("__pick"), F.col(f"__{b}"))).alias(f"__{b}") for b in fields])
    decided = {"group_size": F.col("frames"), "group_best": F.col("__own.filename"), "duplicate_status": F.lit("representative"), "phash_distance_to_group_best": F.lit(0), "angle_distance_to_group_best": F.lit(0.0)}
    return got.select(*names, *[F.col(f"__{b}").getField(c).alias(c) for b, cs in fields.items() for c in cs], *[v.cast(types[c]).alias(c) for c, v in decided.items()])
