"""The steps in a row, the command line, review, restoration and packaging."""

import pytest
from pyspark.sql import functions as F

from lumisift.__main__ import main, parser
from lumisift.params import GateParams
from lumisift.plans import pipeline
from lumisift.sources import reports


@pytest.fixture(scope="module")
def measured(spark, small):
    """Latest rows of step 6 with the hashes of step 5, as if freshly measured."""
    six = spark.read.parquet(f"{small}/step6_dataset_report.parquet").dropDuplicates(["frame_id"])
    five = spark.read.parquet(f"{small}/step5_dataset_report.parquet").groupBy("frame_id").agg(F.max("global_hash").alias("global_hash"), F.max("face_hash").alias("face_hash"))
    return six.join(five, "frame_id", "left").cache()


def test_steps_in_a_row(measured):
    out = pipeline.run_steps(measured).cache()
    assert out.count() == measured.count() and out.select("seq").distinct().count() == measured.count()
    n = {r["step_name"] for r in out.select("step_name").distinct().collect()}
    assert n == {"STEP7_LORA_CANDIDATE_SELECTION"}
    assert out.filter("face_eligible and not array_contains(array('representative', 'unique', 'duplicate', 'error'), duplicate_status)").count() == 0
    groups = out.filter("duplicate_group is not null").groupBy("duplicate_group").agg(F.count_if(F.col("duplicate_status") != "duplicate").alias("kept"), F.count(F.lit(1)).alias("n"), F.max("group_size").alias("size"))
    assert groups.filter("kept <> 1 or n <> size").count() == 0
    ranks = sorted(r[0] for r in out.filter("candidate_selected").select("candidate_rank").collect())
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
    assert out.filter("candidate_selected and not coalesce(identity_passed, false)").count() == 0
    again = pipeline.run_steps(out)  # nothing stale survives a rerun
    assert sorted(map(str, again.select("seq", "quota_status", "candidate_rank").collect())) == sorted(map(str, out.select("seq", "quota_status", "candidate_rank").collect()))


def test_gate_on_disk_values(measured):
    a = pipeline.gate_step(measured, GateParams(), as_on_disk=True)
    assert a.count() == measured.count()
    strict = pipeline.gate_step(measured, GateParams(min_eye_sharpness=99.0))
    assert strict.filter("face_eligible and shot_type <> 'FULL_BODY'").count() == 0


def test_command_line(spark, measured, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    reports.write_report(measured, source, measured.columns, ["seq"], single_file=True)
    assert main(["gate", "--report", source, "--output", target, "--min-eye-sharpness", "1.2"]) == 0
    back = reports.read_report(spark, target, 7)
    assert back.count() == measured.count() and back.filter("step_name = 'STEP3_FACE_GATE'").count() == measured.count()
    assert parser().parse_args(["select", "--report", "a", "--output", "b"]).target == 65


def test_review_restoration_packaging(spark):
    rows = spark.createDataFrame([("a/x_1.png", True, "FULL_BODY", 100, 3.0, "FRONT", 0.7, 0.69, 0.9), ("a/x_2.png", True, "CLOSE_UP", 300, 3.0, "FRONT", 0.7, 0.7, 0.9), ("a/x_3.png", True, "FULL_BODY", 100, 3.0, None, 0.7, 0.5, 0.9), ("a/x_4.png", False, None, None, None, None, None, None, None)], "filename string, candidate_selected boolean, shot_type string, face_min_dimension int, eye_sharpness double, pose_bucket string, identity_sim_before double, identity_sim_after double, fidelity_to_orig double").withColumn("seq", F.monotonically_increasing_id())
    kept = pipeline.apply_review(rows, rows.filter("filename like '%x_2%'").select("filename"))
    restored = pipeline.restore_step(kept)
    assert {r["filename"]: r["restoration_status"] for r in restored.collect()} == {"a/x_1.png": "safely_restored", "a/x_3.png": "rollback_to_original"}
    assert {r["restoration_status"] for r in pipeline.restore_step(kept, model_loaded=False).collect()} == {"untouched_raw_camera"}
    pictures = spark.createDataFrame([("01_x_1.png", 1079, 1920), ("02_CLOSE_UP_LEFT_3Q_zz.png", 10, 10), ("03_gone.png", None, None), ("04_y.png", 5, 5)], "filename string, width int, height int")
    for c in ("expression_desc", "clothing_desc", "hair_desc", "bg_desc", "lighting_desc"):
        pictures = pictures.withColumn(c, F.lit(c[:3]))
    status = spark.createDataFrame([("01_x_1.png", 1, "safely_restored")], "filename string, seq bigint, restoration_status string")
    got = {r["final_filename"]: r for r in pipeline.package_step(pictures, rows, status).collect()}
    assert set(got) == {"character_01.png", "character_02.png", "character_04.png"}
    first, second = got["character_01.png"], got["character_02.png"]
    assert (first["shot_type"], first["pose_bucket"], first["aligned_width"], first["restoration_status"]) == ("FULL_BODY", "FRONT", 1072, "safely_restored")
    assert (second["shot_type"], second["pose_bucket"], second["restoration_status"]) == ("CLOSE_UP", "LEFT_3Q", "untouched_raw_camera")
    assert second["flux_caption"].startswith("extreme close-up portrait of character")
