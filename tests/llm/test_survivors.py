import itertools
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lumisift.llm import survivors
from lumisift.schemas import report_schema

T0 = datetime(2026, 1, 1)


def table(spark, rows):
    base = spark.createDataFrame([], report_schema(5))
    extra = "seq bigint, frame_id bigint, run_id bigint, reported_at timestamp, global_hash bigint, face_hash bigint, "
    fields = [f for f in base.schema.fields if f.name != "step_name"]
    ddl = extra + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    names = [x.strip().split(" ")[0] for x in extra.split(",") if x.strip()] + [f.name for f in fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl).withColumns({"grp": F.lit(1), "score": F.lit("x"), "shot": F.lit(2), "options": F.lit(3)})


def row(seq, frame, group, score, minute=0, run=1, **more):
    return {"seq": seq, "frame_id": frame, "run_id": run, "duplicate_group": group, "face_quality_score": score, "reported_at": T0 + timedelta(minutes=minute), "filename": f"s/f{frame}.png", **more}


def test_choice_of_the_frame(spark):
    rows = [
        row(1, 1, "c1", 100.0), row(2, 2, " C1 ", 300.0), row(3, 2, "c1", 90.0, minute=5), row(4, 3, "c1", 99999.0), row(5, 1, "c1", 100.0),
        row(6, 7, "c2", None), row(7, 8, "c2", float("nan")),  # no possible score
        row(8, 9, "c3", 50.0), row(9, 9, "c3", 60.0),  # one frame
        row(10, 5, "c4", 70.0), row(11, 4, "c4", 70.0),  # tie
        row(12, 5, None, 70.0), row(13, 5, "  ", 70.0), row(14, None, "c4", 900.0),
        row(15, 6, "c1", 80.0, run=2), row(16, 3, "c1", 5.0, run=2),
    ]
    got = {(r["run_id"], r["duplicate_group"]): r["frame_id"] for r in survivors.choose_survivors(table(spark, rows)).collect()}
    assert got == {(1, "c1"): 1, (1, "c4"): 4, (2, "c1"): 6}


def test_empty(spark):
    assert survivors.choose_survivors(table(spark, [])).collect() == []
    assert survivors.fill_survivors(table(spark, [])).collect() == []


def test_bundles_stay_whole_and_consistent(spark):
    good_shot = dict(shot_type="CLOSE_UP", face_area_ratio=0.2, face_min_dimension=200, source_short_edge=1080, face_bbox_x=1, face_bbox_y=1, face_bbox_width=2, face_bbox_height=2)
    poor_shot = dict(shot_type="FULL_BODY", face_area_ratio=0.01)
    full_pose = dict(pose_yaw=1.0, pose_pitch=2.0, pose_roll=3.0, pose_bucket="FRONT", pose_cluster_key="FULL_BODY_FRONT")
    close_pose = dict(pose_yaw=9.0, pose_pitch=None, pose_roll=None, pose_bucket="FRONT", pose_cluster_key="Close-Up Front")
    rows = [row(1, 1, "g", 10.0, **good_shot, **full_pose), row(2, 2, "g", 20.0, **poor_shot, **close_pose), row(3, 3, "g", 5.0, eye_sharpness=2.0, mouth_sharpness=1.0)]
    got = survivors.fill_survivors(table(spark, rows)).collect()[0]
    assert got["frame_id"] == 2
    assert (got["shot_type"], got["pose_cluster_key"], got["pose_yaw"]) == ("CLOSE_UP", "Close-Up Front", 9.0)  # the better pose contradicts the shot
    assert got["eye_sharpness"] == 2.0 and got["global_hash"] is None


def test_every_column_of_the_report_is_filled(spark):
    light = dict(face_brightness_mean=120.0, face_to_global_brightness_ratio=1.1, face_central_gradient=0.2)
    seen = dict(face_visibility_score=0.9, occlusion_detected=False, occlusion_level="NONE", face_visibility_signals=["a"], eye_ratio_left=0.4)
    rows = [
        row(1, 1, "g", 10.0, skin_texture_score=5.0, plasticity_ratio=0.1, face_brightness_mean=float("nan"), scene_group="s", **seen),
        row(2, 2, "g", 20.0, file_size_bytes=7, temporal_index=3, group_best="wrong.png", duplicate_status="duplicate", group_size=9, pose_status="failed", face_visibility_score=0.1),
        row(3, 3, "g", 5.0, file_size_bytes=8, shadow_pixel_ratio=0.1, face_laplacian_score=2.0, face_eligible=True, face_gate_category="OK", face_gate_reason=[], **light),
        row(4, 2, "g", 20.0, minute=9, file_size_bytes=6, temporal_index=3, pose_status="failed"),
    ]
    t = table(spark, rows)
    got = survivors.fill_survivors(t).collect()[0].asDict()
    assert set(got) == {*t.columns, "frames"} - {"grp", "score", "shot", "options"}
    assert (got["frame_id"], got["seq"], got["filename"], got["file_size_bytes"], got["temporal_index"]) == (2, 4, "s/f2.png", 6, 3)
    assert {k: got[k] for k in (*light, *seen)} == {**light, **seen}
    assert (got["skin_texture_score"], got["shadow_pixel_ratio"], got["face_laplacian_score"], got["scene_group"], got["pose_status"]) == (5.0, 0.1, 2.0, "s", "failed")
    assert (got["face_eligible"], got["face_gate_category"], got["face_gate_reason"]) == (True, "OK", [])
    assert (got["group_size"], got["group_best"], got["duplicate_status"], got["phash_distance_to_group_best"]) == (3, "s/f2.png", "representative", 0)


def test_search_finds_the_optimum():
    rnd = random.Random(3)
    for _ in range(300):
        options = {}
        for b in survivors.ORDER:
            n = rnd.randrange(4)
            options[b] = [(round(rnd.random() * 5, 3), rnd.choice(["", "closeup", "fullbody"]), rnd.choice(["", "closeup", "fullbody"]), i) for i in range(n)]
        got = sum(o[0] for o in survivors.best_bundles(options).values())
        best = 0.0
        for combo in itertools.product(*[[None, *options[b]] for b in survivors.ORDER]):
            shot = combo[0][1] if combo[0] else ""
            if combo[1] and shot and combo[1][2] and combo[1][2] != shot:
                continue
            best = max(best, sum(o[0] for o in combo if o))
        assert abs(got - best) < 1e-9
