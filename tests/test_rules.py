"""Goldens of the rules, names and math."""

import pytest
from pyspark.sql import functions as F

from lumisift.functions import captions, names
from lumisift.functions.math import align_up_down, hamming, sign_hash
from lumisift.operators import gate, pose, select
from lumisift.params import GateParams
from lumisift.schemas import report_schema, with_columns_once


def values(spark, ddl, rows, *columns):
    return [tuple(r) if len(columns) > 1 else r[0] for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_shot_type(spark):
    assert values(spark, "a double", [(0.12,), (0.0399,), (0.04,), (None,)], gate.shot_type(F.col("a"))) == ["CLOSE_UP", "FULL_BODY", "UPPER_BODY", None]


def test_pose_bucket(spark):
    rows = [(15.0, 0.0, 0.0), (15.01, 0.0, 0.0), (-42.0, 0.0, 0.0), (42.01, 0.0, 0.0), (0.0, 20.0, 0.0), (0.0, 20.01, 0.0), (0.0, -20.01, 0.0), (0.0, 35.01, 0.0), (90.0, 0.0, 35.01), (None, 0.0, 0.0), (float("nan"), 0.0, 0.0)]
    got = values(spark, "y double, p double, r double", rows, pose.pose_bucket(F.col("y"), F.col("p"), F.col("r")))
    assert got == ["FRONT", "RIGHT_3Q", "LEFT_3Q", "RIGHT_PROFILE", "FRONT", "LOOKING_DOWN", "LOOKING_UP", "EXTREME_POSE", "EXTREME_POSE", None, None]


def test_thresholds_and_classes(spark):
    rows = [("CLOSE_UP", "FRONT", 0.0), ("CLOSE_UP", "LEFT_PROFILE", -55.0), ("FULL_BODY", "RIGHT_PROFILE", 60.0), ("UNKNOWN", "foo", 0.0), ("CLOSE_UP", "FRONT", 50.0), (None, None, None)]
    assert values(spark, "s string, p string, y double", rows, pose.dynamic_threshold(F.col("s"), F.col("p"), F.col("y"))) == pytest.approx([0.62, 0.49, 0.45, 0.54, 0.62, 0.54])
    rows = [(0.62,), (0.575,), (0.56,), (None,)]
    assert values(spark, "x double", rows, pose.similarity_class(F.col("x"), F.lit(0.62))) == ["PASSED", "REVIEW", "REJECT_IDENTITY", None]


def test_align(spark):
    assert values(spark, "v int", [(1080,), (1079,), (1920,), (7,), (8,)], align_up_down(F.col("v"))) == [1088, 1072, 1920, 16, 16]


def test_scene_and_index(spark):
    rows = [("vidA/vidA_007.png",), ("a_b_003.png",), ("x.png",), ("v\\s\\f_12_x.png",), (None,)]
    got = values(spark, "f string", rows, names.scene_of(F.col("f")), names.temporal_index(F.col("f")))
    assert got[:4] == [("vidA", 7), ("a_b", 3), ("x", 0), ("v", 12)] and got[4][0] is None


def test_paths_and_names(spark):
    rows = [("a/b.PNG",), ("",), ("/abs.png",), ("a/../b",), ("C:\\x.png",), ("a\\b.png",), (None,)]
    assert values(spark, "p string", rows, names.safe_path(F.col("p"))) == ["a/b.PNG", None, None, None, None, "a/b.png", None]
    row = [(3, 7.25, "01_CLOSE_UP_left_3q_x.png")]
    assert values(spark, "r int, s double, n string", row, names.candidate_name(F.col("r"), F.col("s"), F.lit("A"), F.lit("B"), F.lit("c.png")), names.shot_in_name(F.col("n")), names.pose_in_name(F.col("n"))) == [("03_score007.3_A_B_c.png", "CLOSE_UP", "LEFT_3Q")]


def gate_row(**kw):
    base = dict(face_gate_status="ok", face_detected=True, face_count=1, laplacian_score=100.0, shot_type="UPPER_BODY", source_short_edge=1080, face_min_dimension=300, facemesh_detected=True, face_visibility_score=95.0, face_central_gradient=10.0, eye_presence_valid=True, face_brightness_mean=130.0, face_to_global_brightness_ratio=1.0, beauty_filter_detected=False, eye_sharpness=3.0, face_laplacian_score=200.0)
    return base | kw


@pytest.fixture(scope="module")
def gated(spark):
    cases = {
        "ok": gate_row(), "error": gate_row(face_gate_status="error", face_count=None, face_detected=None, laplacian_score=None), "blur_small": gate_row(face_laplacian_score=10.0, face_min_dimension=50),
        "low_res": gate_row(shot_type="FULL_BODY", source_short_edge=700, beauty_filter_detected=True), "none": gate_row(face_detected=False, face_count=0), "two": gate_row(face_count=2), "dark": gate_row(face_brightness_mean=90.0),
        "backlit": gate_row(face_brightness_mean=100.0, face_to_global_brightness_ratio=0.6), "nan": gate_row(eye_sharpness=float("nan")),
    }
    schema = report_schema(3)
    rows = [tuple(case.get(f.name) for f in schema.fields[1:]) for case in cases.values()]
    df = spark.createDataFrame([(k, *r) for k, r in zip(cases, rows)], "step_name string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields[1:]))
    return {r["step_name"]: r for r in gate.apply_gate(df).collect()}


def test_gate(gated):
    assert gated["ok"]["face_eligible"] and gated["ok"]["face_gate_category"] == "ELIGIBLE"
    assert gated["error"]["face_gate_reason"] == ["analysis_error", "multiple_faces", "global_blurry"] and gated["error"]["face_gate_category"] == "REVIEW_UNKNOWN"
    assert gated["blur_small"]["face_gate_category"] == "REJECT_BLUR" and gated["low_res"]["face_gate_category"] == "REJECT_LOW_RES"
    assert gated["none"]["face_gate_reason"] == ["no_face"] and gated["two"]["face_gate_category"] == "REJECT_MULTIPLE_FACE"
    assert gated["dark"]["face_gate_reason"] == ["face_underexposed"] and gated["backlit"]["face_gate_reason"] == ["face_backlit_underexposed"]
    assert gated["nan"]["face_gate_reason"] == ["face_blurry"]


def test_beauty_filter_can_be_skipped(spark):
    df = spark.createDataFrame([tuple(gate_row(beauty_filter_detected=True).values())], ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in gate_row().items()))
    assert df.select(gate.gate_reasons(GateParams(skip_beauty_filter=True))).first()[0] == []


SCORED = "identity_similarity_mean double, eye_sharpness double, mouth_sharpness double, shot_type string, face_min_dimension int, face_brightness_mean double, face_to_global_brightness_ratio double, pose_bucket string, eye_presence_valid boolean, face_laplacian_score double"


def test_scores(spark):
    none = (None,) * 10
    got = spark.createDataFrame([none, (None, 3.0, 1.2, None, None, 130.0, None, None, True, 120.0), (0.0,) + (None,) * 9], SCORED).select(select.candidate_score().alias("c"), select.score_reason().alias("r"), select.quality_score().alias("q")).collect()
    assert got[0]["c"] == pytest.approx(36.1111, abs=1e-3) and got[0]["r"] == "ID=5.0+Sharp=0.0+Res=11.1+Exp=20.0+Bonus=0" and got[0]["q"] == 0.0
    assert got[1]["q"] == pytest.approx(1404.0)
    assert got[2]["r"].startswith("ID=0.0")  # a real 0 is not missing


def test_visibility(spark):
    ok = gate.visibility_signals(F.lit(0.9), F.lit(0), F.lit(0.2), F.lit(0.2), F.lit(0.1), F.lit(0.9), F.lit(False), F.lit(True), F.lit(True))
    bad = gate.visibility_signals(F.lit(0.5), F.lit(4), F.lit(0.01), F.lit(0.2), F.lit(0.5), F.lit(0.1), F.lit(True), F.lit(True), F.lit(True))
    no_mesh = gate.visibility_signals(F.lit(0.9), F.lit(0), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(False), F.lit(False), F.lit(True))
    r = spark.range(1).select(ok.alias("ok"), bad.alias("bad"), no_mesh.alias("none")).first()
    assert (r["ok"]["score"], r["ok"]["level"], r["ok"]["signals"]) == (100.0, "none", [])
    assert (r["bad"]["score"], r["bad"]["level"], len(r["bad"]["signals"])) == (0.0, "heavy", 6)
    assert (r["none"]["score"], r["none"]["level"], r["none"]["signals"]) == (0.0, "unknown", ["landmarks_not_found"])


def test_hashes(spark):
    a = [float(i % 7) for i in range(64)]
    df = spark.createDataFrame([(a, [-x for x in a], [7.0 - x for x in a])], "a array<float>, b array<float>, c array<float>")
    r = df.select(hamming(sign_hash(F.col("a")), sign_hash(F.col("a"))).alias("same"), hamming(F.lit(-1).cast("bigint"), F.lit(0).cast("bigint")).alias("all"), sign_hash(F.col("a")).alias("h")).first()
    median = sorted(a[8:])[27:29]
    assert (r["same"], r["all"]) == (0, 64)
    assert r["h"] % 2**64 == sum(1 << i for i, x in enumerate(a) if x > sum(median) / 2)


def test_captions(spark):
    attrs = {k: F.lit(k) for k in captions.ATTRIBUTES}
    df = spark.createDataFrame([("CLOSE_UP", "LEFT_3Q"), ("x", None)], "s string, p string")
    got = df.select(captions.caption("qx", F.col("s"), F.col("p"), attrs).alias("c"), captions.best_label(F.array(F.lit(0.1), F.lit(0.7), F.lit(0.7)), ["a", "b", "c"]).alias("b")).collect()
    assert got[0]["c"].startswith("extreme close-up portrait of qx, a young woman, turned slightly") and got[0]["b"] == "b"
    assert got[1]["c"].startswith("photograph of qx, a young woman, natural candid pose")


def test_column_order():
    assert with_columns_once(["a", "b"], ["b", "c"]) == ["a", "b", "c"]
