"""The command line of every step, on small folders, with a stand-in for the external programs."""

import os
import stat

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.__main__ import main, parser
from lumisift.functions import kernels
from lumisift.operators import lookup
from lumisift.sources import reports, sinks


@pytest.fixture
def programs(tmp_path):
    """Stand-ins: the probe says 4 seconds, the extractor writes its second to the output and fails for videos named bad."""
    probe, tool = tmp_path / "probe", tmp_path / "tool"
    probe.write_text('#!/bin/sh\necho \'{"format": {"duration": "4.0"}}\'\n')
    tool.write_text('#!/bin/sh\ncase "$6" in *bad*) exit 1;; esac\nprintf "picture at %s" "$4"\n')
    for f in (probe, tool):
        f.chmod(f.stat().st_mode | stat.S_IEXEC)
    return str(probe), str(tool)


def test_extract(spark, tmp_path, programs):
    videos, out = tmp_path / "videos", tmp_path / "out"
    videos.mkdir()
    for name in ("a.mp4", "bad.mov", "notes.txt"):
        (videos / name).write_text("x")
    args = ["extract", "--input", str(videos), "--output", str(out), "--num-frames", "3", "--ffprobe", programs[0], "--ffmpeg", programs[1]]
    assert main(args) == 0
    assert (out / "a" / "a_001.png").read_text() == "picture at 0.500" and (out / "a" / "a_003.png").read_text() == "picture at 3.500"
    assert not (out / "bad").exists()
    rows = {r["output_folder"]: r for r in spark.read.option("header", True).csv(str(out / "step1_extract_report")).collect()}
    assert (rows["a"]["frames_extracted"], rows["a"]["target_frames"], rows["bad"]["frames_extracted"]) == ("3", "3", "0")
    (out / "a" / "a_002.png").unlink()
    assert main(args) == 0 and (out / "a" / "a_002.png").exists()  # only what is missing


def test_review_fills_an_empty_selection_only(tmp_path):
    candidates, selected = tmp_path / "candidates", tmp_path / "selected"
    candidates.mkdir()
    for i in range(5):
        (candidates / f"{i:02d}_CLOSE_UP_FRONT.png").write_text(str(i))
    args = ["review", "--candidates", str(candidates), "--selected", str(selected), "--target-count", "3", "--populate-defaults"]
    assert main(args) == 0 and sorted(os.listdir(selected)) == [f"{i:02d}_CLOSE_UP_FRONT.png" for i in range(3)]
    os.remove(selected / "00_CLOSE_UP_FRONT.png")
    assert main(args) == 0 and len(os.listdir(selected)) == 2


def test_all_steps_from_one_report(spark, small, tmp_path):
    six = spark.read.parquet(f"{small}/step6_dataset_report.parquet").dropDuplicates(["frame_id"])
    five = spark.read.parquet(f"{small}/step5_dataset_report.parquet").groupBy("frame_id").agg(F.max("global_hash").alias("global_hash"), F.max("face_hash").alias("face_hash"))
    measured = six.join(five, "frame_id", "left")
    source, out = str(tmp_path / "in"), tmp_path / "out"
    reports.write_report(measured, source, measured.columns, ["seq"], single_file=True)
    pictures, measures = str(tmp_path / "pictures"), str(tmp_path / "measures")
    names = six.select("filename").orderBy("seq").limit(4)
    names.withColumns({"width": F.lit(1079), "height": F.lit(1920), "hair_desc": F.lit("short hair")}).coalesce(1).write.option("header", True).csv(pictures)
    six.select("filename", F.lit(0.7).alias("identity_sim_before"), F.lit(0.69).alias("identity_sim_after"), F.lit(0.9).alias("fidelity_to_orig")).coalesce(1).write.option("header", True).csv(measures)
    assert main(["all", "--report", source, "--output", str(out), "--measures", measures, "--pictures", pictures]) == 0
    n = measured.count()
    for step in range(2, 8):
        assert reports.read_report(spark, str(out / f"step{step}"), 7).count() == n
    chosen = reports.read_report(spark, str(out / "step7"), 7).filter("candidate_selected").count()
    nine = reports.read_report(spark, str(out / "step9"), 7)
    assert nine.count() == chosen and set(r[0] for r in nine.select("restoration_status").distinct().collect()) <= {"untouched_raw_camera", "safely_restored", "rollback_to_original"}
    assert len(os.listdir(out / "step10" / "captions")) >= 4 and "## Training" in (out / "step10" / "TRAINING_GUIDE.md").read_text()
    assert spark.read.text(str(out / "step10" / "metadata")).count() == 4
    assert main(["restore", "--report", str(out / "step7"), "--output", str(tmp_path / "r"), "--many-files", "--one-line-rows"]) == 0
    assert parser().parse_args(["package", "--pictures", "a", "--report", "b", "--output", "c"]).trigger == "character"


def test_review_manifests_and_copies(spark, tmp_path):
    rows = spark.createDataFrame([("s/a.png", "ELIGIBLE", "FRONT", "PASSED", 0.61234), ("s/b.png", "REJECT_BLUR", None, None, None)], "filename string, face_gate_category string, pose_bucket string, identity_class string, identity_similarity_mean double")
    targets = lambda df: sorted(r["target"] for r in df.collect())
    assert targets(sinks.category_review(rows)) == ["ELIGIBLE/s/a.png", "REJECT_BLUR/s/b.png"]
    assert targets(sinks.pose_review(rows)) == ["FRONT/FRONT_a.png"]
    assert targets(sinks.identity_review(rows)) == ["PASSED/sim0.6123_a.png"]
    (tmp_path / "in" / "s").mkdir(parents=True)
    (tmp_path / "in" / "s" / "a.png").write_text("A")
    sinks.copy_files(sinks.category_review(rows), str(tmp_path / "in"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "ELIGIBLE" / "s" / "a.png").read_text() == "A" and not (tmp_path / "out" / "REJECT_BLUR").exists()


def test_face_kernels():
    rng = np.random.default_rng(1)
    gray, sat, val = (rng.integers(0, 256, (80, 100)).astype(float) for _ in range(3))
    mesh = [(0.5, 0.5)] * 470
    for i, at in {33: (0.2, 0.3), 133: (0.4, 0.3), 263: (0.8, 0.3), 362: (0.6, 0.3), 10: (0.5, 0.1), 234: (0.1, 0.5), 152: (0.5, 0.9), 454: (0.9, 0.5)}.items():
        mesh[i] = at
    left, right = kernels.eye_presence(sat, val, mesh)
    cut = lambda p, x: p[24 - 10 : 24 + 10, x - 16 : x + 16]  # noqa: E731 - eyes 20 pixels wide: 16 to each side, 10 up and down
    for got, x in ((left, 30), (right, 70)):
        s, v = cut(sat, x), cut(val, x)
        assert got == pytest.approx(((s < 55) & (v > 115)).mean() + (v < 75).mean())
    assert kernels.eye_presence(sat, val, None) == (0.0, 0.0) and kernels.central_gradient(gray, None) == 0.0
    assert kernels.central_gradient(np.full((80, 100), 7.0), mesh) == 0.0 < kernels.central_gradient(gray, mesh)
    assert kernels.identity_crop(gray, (10, 20, 40, 20)).shape == (30, 60)
    for box in ((0, 0, 0, 0), (500, 500, 10, 10), (None, None, None, None)):
        assert np.array_equal(kernels.identity_crop(gray, box), gray[0:56, 22:78])
    assert kernels.cut_patch(gray, (-50.0, 5.0), (3, 3)).size == 0


@pytest.mark.parametrize("least", [None, 5])
def test_lookups_with_half_of_the_rows_on_one_key(spark, least):
    names = [(i, "common/prefix/scene_a/x.png" if i % 2 else f"common/prefix/scene_{i}/x.png") for i in range(60)] + [(99, None)]
    keys = [(f"common/prefix/scene_{i}", i) for i in range(0, 60, 4)] + [("common/prefix/scene_a", 100), ("x.png", 200), ("", 1), (None, 2)]
    got = lookup.substring_join(spark.createDataFrame(names, "i bigint, name string"), "name", spark.createDataFrame(keys, "k string, s bigint"), "k", "s", least=least).collect()
    first = lambda n: min(((s, k) for k, s in keys if k and n and k in n), default=(None, None))[1]
    assert {r["i"]: r["k"] for r in got} == {i: first(n) for i, n in names}


def test_head_pose_recovers_a_known_turn(spark):
    rnd = np.random.default_rng(3)
    model = np.array(kernels.MODEL_HEAD)
    rows = []
    for i in range(25):
        yaw, pitch, roll = rnd.uniform([-55, -35, -30], [55, 35, 30])
        cx, cy, cz = (np.radians(x) for x in (pitch, yaw, roll))
        turn = kernels._turn(np.array([0, 0, cz])) @ kernels._turn(np.array([0, cy, 0])) @ kernels._turn(np.array([cx, 0, 0]))
        seen = model @ turn.T + [30.0, -20.0, 1500.0 + 40 * i]
        at = seen[:, :2] / seen[:, 2:] * 640 + [320, 240]
        mesh = [[0.5, 0.5]] * 292
        for k, (x, y) in zip(kernels.POSE_POINTS, at):
            mesh[k] = [float(x) / 640, float(y) / 480]
        assert kernels.head_pose(mesh, 640, 480) == pytest.approx((yaw, pitch, roll), abs=1e-3)
        rows.append((i, mesh))
    got = spark.createDataFrame([*rows, (99, None), (100, [[0.5, 0.5]])], "i int, m array<array<double>>").select("i", kernels.head_pose_udf(F.col("m"), F.lit(640), F.lit(480)).alias("p")).select("i", "p.*").collect()
    assert all(r["pose_error"] is None and r["pose_yaw"] is not None for r in got if r["i"] < 25)
    assert {r["i"]: r["pose_error"] for r in got if r["i"] > 25}[99] == "no face" and got[-1]["pose_yaw"] is None
    assert kernels.head_pose(None, 640, 480) is None


def test_report_beside_a_locked_target(spark, tmp_path, monkeypatch):
    from datetime import datetime

    assert reports.stamped("out/step3.csv", datetime(2026, 1, 2, 3, 4, 5)) == "out/step3_20260102_030405.csv"
    assert reports.stamped("out.d/step3/", datetime(2026, 1, 2, 3, 4, 5)) == "out.d/step3_20260102_030405"
    rows = spark.createDataFrame([("a",)], "filename string")
    assert reports.write_or_beside(rows, str(tmp_path / "r"), ["filename"]) == str(tmp_path / "r")
    first, real = [True], reports.write_report

    def locked(*args, **kwargs):
        if first.pop() if first else False:
            raise OSError("Permission denied")
        real(*args, **kwargs)

    monkeypatch.setattr(reports, "write_report", locked)
    beside = reports.write_or_beside(rows, str(tmp_path / "s"), ["filename"])
    assert beside.startswith(str(tmp_path / "s_")) and spark.read.option("header", True).csv(beside).count() == 1
