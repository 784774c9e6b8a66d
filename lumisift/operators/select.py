"""Scores of candidates and the quota-constrained selection."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.math import clamp
from ..params import SelectionParams
from ..session import cut_lineage
from .ranks import global_row_number
from .skew import spread_join


#: Shot types and pose buckets that the counters of the selection may hold.
VALUES = 10_000
#: Parts in which the rows of a shot type and pose are cut to what a selection can reach before they meet.
SALTS = 256


def _num(name: str) -> Column:
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def quality_score() -> Column:
    """Score by which the best frame of a cluster is chosen; missing or NaN terms are left out."""
    brightness = _num("face_brightness_mean")
    exposure = F.when(brightness.between(110, 160), 20.0).when((brightness < 95) | (brightness > 210), -30.0).otherwise(0.0)
    capped = lambda c, most, weight: F.when(_num(c).isNotNull(), F.least(_num(c), F.lit(most)) * weight).otherwise(0.0)  # noqa: E731 - least() alone would skip a null
    # The weights and bounds of this score and of the candidate's score below.
    eyes = F.when(F.col("eye_presence_valid"), 1000.0).otherwise(0.0)
    return eyes + capped("eye_sharpness", 10.0, 100.0) + capped("face_laplacian_score", 300.0, 0.5) + capped("mouth_sharpness", 5.0, 20.0) + exposure


def candidate_parts() -> dict[str, Column]:
    """The five parts of a candidate's score; missing inputs count as ordinary ones, a real 0 stays 0."""
    shot = F.coalesce("shot_type", F.lit("UPPER_BODY"))
    pose = F.coalesce("pose_bucket", F.lit("FRONT"))
    similarity = F.coalesce(_num("identity_similarity_mean"), F.lit(0.55))
    eye, mouth = F.coalesce(_num("eye_sharpness"), F.lit(0.0)), F.coalesce(_num("mouth_sharpness"), F.lit(0.0))
    dim = F.coalesce(_num("face_min_dimension"), F.lit(100.0))
    full_size = F.when(shot == "CLOSE_UP", 280.0).when(shot == "UPPER_BODY", 180.0).otherwise(110.0)
    brightness = F.coalesce(_num("face_brightness_mean"), F.lit(120.0))
    backlit = F.coalesce(_num("face_to_global_brightness_ratio"), F.lit(1.0))
    light = F.when(brightness.between(115, 165), 15.0).when(brightness.between(95, 190), 10.0).otherwise(4.0)
    return {
        "ID": clamp((similarity - 0.50) / 0.35, 0.0, 1.0) * 35.0,
        "Sharp": F.least(eye / 4.0, F.lit(1.0)) * 18.0 + F.least(mouth / 2.5, F.lit(1.0)) * 7.0,
        "Res": F.least(dim / full_size, F.lit(1.0)) * 20.0,
        "Exp": light + F.when(backlit >= 0.90, 5.0).when(backlit >= 0.75, 3.0).otherwise(0.0),
        "Bonus": F.when(pose.contains("PROFILE"), 10.0).when(pose.contains("3Q"), 3.0).when(pose == "LOOKING_DOWN", 2.0).otherwise(0.0),
    }


def candidate_score() -> Column:
    return sum(list(candidate_parts().values())[1:], candidate_parts()["ID"])


def score_reason() -> Column:
    """``ID=..+Sharp=..+Res=..+Exp=..+Bonus=..``: one decimal each (half up), the bonus without."""
    parts = candidate_parts()
    shown = [F.format_string(f"{k}=%.1f", F.floor(v * 10 + 0.5) / 10) for k, v in parts.items() if k != "Bonus"]
    return F.concat_ws("+", *shown, F.format_string("Bonus=%d", parts["Bonus"].cast("int")))


def scene_cap(scene: Column, p: SelectionParams = SelectionParams()) -> Column:
    """Frames a scene may give: more for those named after a reference or an identity."""
    name = F.lower(F.coalesce(scene, F.lit("")))
    return F.when(name.contains("reference") | name.contains("identity"), p.max_reference_burst).otherwise(p.max_scene_burst)


def _fold(p: SelectionParams, taken: int, shots: dict, poses: dict):
    """Phases two and three over the pruned pool, in score order, from the counters of phase one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score2", "seq"], ascending=[False, True], kind="stable")
        shot_n, pose_n, scene_n, out = dict(shots), dict(poses), {}, []
        total = taken
        rows = list(zip(pdf["seq"], pdf["scene"], pdf["shot"], pdf["pose"], pdf["cap"], pdf["used"]))
        for seq, scene, shot, pose, cap, used in rows:
            free = scene_n.get(scene, used) < cap
            if free and (shot_n.get(shot, 0) < p.shot_min.get(shot, 0) or pose_n.get(pose, 0) < p.pose_min.get(pose, 0)):
                out.append((seq, 2))
                scene_n[scene] = scene_n.get(scene, used) + 1
                shot_n[shot], pose_n[pose] = shot_n.get(shot, 0) + 1, pose_n.get(pose, 0) + 1
                total += 1
                if total >= p.target:
                    break
        done = {s for s, _ in out}
        for seq, scene, shot, pose, cap, used in rows:
            if total >= p.target:
                break
            if seq in done or scene_n.get(scene, used) >= cap:
                continue
            if shot_n.get(shot, 0) >= p.shot_max.get(shot, p.unknown_max) or pose_n.get(pose, 0) >= p.pose_max.get(pose, p.unknown_max):
                continue
            out.append((seq, 3))
            scene_n[scene] = scene_n.get(scene, used) + 1
            shot_n[shot], pose_n[pose] = shot_n.get(shot, 0) + 1, pose_n.get(pose, 0) + 1
            total += 1
        return pd.DataFrame(out, columns=["seq", "phase"])

    return run


def _counters(rows: DataFrame, value: str) -> dict[str, int]:
    """Rows per value; there are few values by nature, and more than VALUES of them are an error rather than left out."""
    found = rows.groupBy(value).count().limit(VALUES + 1).collect()
    if len(found) > VALUES:
        raise ValueError(f"more than {VALUES} different values of {value}")
    return {r[0]: r[1] for r in found}


def select_by_quota(pool: DataFrame, p: SelectionParams = SelectionParams()) -> DataFrame:
    """Three-phase greedy selection over a pool (seq, scene, shot, pose, score): adds candidate_selected, quota_status, candidate_rank.

    Phase one takes every profile; phase two fills shot and pose minimums within the scene caps and looks at the target after each row it takes;
    phase three fills up to the target within caps and maximums. Rows go by score at two decimals, ties by ``seq``; among the
    selected, ``candidate_rank`` breaks ties by the order of selection.

    Phase one needs no order and stays distributed. The fold of the other phases is exact on a pool pruned to a constant size: counters only
    grow, so a (scene, shot, pose) cell gives a prefix of its rows, at most target + 1, and within a (shot, pose) at most (target + 1)^2
    rows can be passed over because their scene has become full; scenes that phase one has filled give none. Both cuts are made in parts first, so that
    no task gets all rows of a scene or of a shot type and pose.
    """
    rows = cut_lineage(
        pool.select("seq", F.coalesce("scene", F.lit("")).alias("scene"), F.coalesce("shot", F.lit("UPPER_BODY")).alias("shot"), F.coalesce("pose", F.lit("FRONT")).alias("pose"), (F.floor(F.col("score") * 100 + 0.5) / 100).alias("score2")).filter("score2 is not null and seq is not null")
    )
    profile = F.col("pose").contains("PROFILE")
    first = rows.filter(profile)
    shots, poses = _counters(first, "shot"), _counters(first, "pose")
    taken = first.count()
    used = first.groupBy("scene").agg(F.count(F.lit(1)).alias("used"))
    others = rows.filter(~profile)
    rest = spread_join(others, used, ["scene"], F.col("seq"), others.count(), "left").withColumn("used", F.coalesce("used", F.lit(0))).withColumn("cap", scene_cap(F.col("scene"), p)).filter("used < cap")
    most = p.target + 1
    order = [F.desc("score2"), F.asc("seq")]
    for part in (F.pmod(F.xxhash64("seq"), F.lit(SALTS)), F.lit(0)):
        rest = rest.withColumn("part", part)
        rest = rest.withColumn("rn", F.row_number().over(Window.partitionBy("scene", "shot", "pose", "part").orderBy(*order))).filter(F.col("rn") <= most)
    rest = rest.withColumn("part", F.pmod(F.xxhash64("scene"), F.lit(SALTS)))
    for by in (("shot", "pose", "part"), ("shot", "pose")):
        rest = rest.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rn") <= most * most + most)
    rest = rest.drop("rn", "part")
    picks = rest.groupBy(F.lit(0).alias("g")).applyInPandas(_fold(p, taken, shots, poses), "seq bigint, phase int")
    marked = rows.join(F.broadcast(picks), "seq", "left").withColumn("phase", F.when(profile, 1).otherwise(F.col("phase")))
    status = F.when(F.col("phase") == 1, "selected_profile_priority").when(F.col("phase") == 2, "selected_quota_minimum").when(F.col("phase") == 3, "selected_score_fill").otherwise("rejected_quota_exceeded")
    marked = cut_lineage(marked.withColumn("quota_status", status).withColumn("candidate_selected", F.col("phase").isNotNull()))
    ranked = global_row_number(marked.filter("candidate_selected").select("seq", "score2", "phase"), [-F.col("score2"), F.col("phase"), F.col("seq")], "candidate_rank")
    out = marked.join(ranked.select("seq", "candidate_rank"), "seq", "left")
    return out.select("seq", "scene", "shot", "pose", "score2", F.concat_ws("_", "shot", "pose").alias("quota_cell"), "quota_status", "candidate_selected", "candidate_rank")


def quota_distribution(selected: DataFrame, by: str, least: dict, most: dict, unknown_max: int = 999) -> DataFrame:
    """Selected rows per value against its minimum and maximum, and their share in ten-thousandths; values with a minimum are listed even at 0."""
    spark = selected.sparkSession
    names = sorted({*least, *most})
    dim = spark.createDataFrame([(k, least.get(k, 0), most.get(k, unknown_max)) for k in names], f"{by} string, least int, most int")
    counts = selected.filter("candidate_selected").groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(F.broadcast(dim), by, "full")
    n = F.coalesce("n", F.lit(0))
    total = F.sum(n).over(Window.partitionBy())
    return joined.select(by, n.alias("n"), F.coalesce("least", F.lit(0)).alias("least"), F.coalesce("most", F.lit(unknown_max)).alias("most"), F.floor(n * 10000 / F.greatest(total, F.lit(1)) + 0.5).cast("bigint").alias("share_e4"))
