"""Sources, sinks, streams, the catalog and the driver's entry."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lumisift.plans import catalog
from lumisift.schemas import report_schema
from lumisift.sources import environment, files, media, reports, sinks
from lumisift.streaming import incremental


def test_csv_round_trip(spark, tmp_path):
    path = tmp_path / "step3_dataset_report.csv"
    path.write_bytes("﻿filename,width,face_eligible,face_gate_reason,error,extra\r\na/b.png,12,true,x;y,\"two\nlines, \"\"q\"\"\",1\r\nc.png,bad,,,,\r\n".encode())
    df = reports.read_report(spark, str(path), 3)
    rows = df.collect()
    assert rows[0]["width"] == 12 and rows[0]["face_eligible"] is True and rows[0]["face_gate_reason"] == ["x", "y"] and rows[0]["error"] == 'two\nlines, "q"'
    assert rows[1]["width"] is None and rows[1]["face_gate_reason"] is None
    out = str(tmp_path / "out")
    reports.write_report(df, out, ["filename", "face_eligible", "face_gate_reason", "absent"], ["filename"], single_file=True)
    back = spark.read.option("header", True).csv(out).collect()
    assert [tuple(r) for r in back] == [("a/b.png", "true", "x;y", None), ("c.png", None, None, None)]
    with pytest.raises(ValueError):
        reports.require(df, ["filename", "nothing"])


def test_listings(spark, tmp_path):
    for name in ("B_2.PNG", "a_1.png", "v.mp4", "w.MOV", "note.txt", "sub dir/c+3.jpg"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    root = str(tmp_path)
    assert [r["filename"] for r in files.videos(spark, root).collect()] == ["v.mp4", "w.MOV"]
    assert [(r["seq"], r["filename"]) for r in files.images(spark, root).orderBy("seq").collect()] == [(1, "a_1.png"), (2, "B_2.PNG"), (3, "sub dir/c+3.jpg")]
    assert files.latest_report(spark, root, 4) is None
    (tmp_path / "step4_dataset_report_x.csv").write_text("filename\n")
    assert files.latest_report(spark, root, 4).endswith("step4_dataset_report_x.csv")
    assert files.first_existing(["/nowhere", root]) == root


def test_durations(spark):
    rows = [('{"format": {"duration": "3.5"}}', 10, 2.0), ("junk", 10, 2.0), (None, None, None)]
    df = spark.createDataFrame(rows, "j string, n int, fps double")
    assert [r[0] for r in df.select(media.duration(F.col("j"), F.col("n"), F.col("fps"))).collect()] == [3.5, 5.0, 0.0]
    planned = spark.createDataFrame([("v", "v_001.png", 0.5), ("w", "w_001.png", 0.5)], "video string, frame string, t double")

    def first(video, t):
        if video == "w":
            raise OSError("no such file")
        return b"picture"

    got = {r["video"]: r for r in media.extract_frames(planned, [first]).collect()}
    assert bytes(got["v"]["content"]) == b"picture" and got["w"]["error"] == "no such file"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a_1.png", "Ein »Bild«", "t", 16, None, "CLOSE_UP", "FRONT", "ok")], "final_filename string, flux_caption string, tags_caption string, aligned_width int, aligned_height int, shot_type string, pose_bucket string, restoration_status string")
    sinks.write_json_lines(rows, str(tmp_path / "j"))
    record = json.loads(spark.read.text(str(tmp_path / "j")).first()[0])
    assert record["text"] == "Ein »Bild«" and record["height"] is None and list(record)[:2] == ["image", "text"]
    sinks.partitioned_manifest(rows, "shot_type", str(tmp_path / "m"), ["final_filename", "shot_type"])
    assert (tmp_path / "m" / "shot_type=CLOSE_UP").is_dir()
    names = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    assert [r["name"] for r in sinks.populate_selected(names, names.limit(0), first=2).collect()] == ["a", "b"]
    assert sinks.populate_selected(names, names, first=2).collect() == []


def test_restored_pictures(spark, tmp_path):
    rows = spark.createDataFrame([("s\\a.png", "safely_restored"), ("s/b.png", "rollback_to_original")], "filename string, restoration_status string")
    folder = str(tmp_path)

    def pictures(row):
        import numpy as np

        return np.zeros((40, 40), np.uint8), np.zeros((20, 20), np.uint8), np.full((64, 64), 200, np.uint8), (10, 10)

    def writer(name, pixels):
        import os

        import numpy as np

        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        np.save(f"{folder}/{name}.npy", pixels)

    sinks.write_restored(rows, pictures, writer)
    import numpy as np

    got = {str(p.relative_to(tmp_path)): np.load(p) for p in tmp_path.rglob("*.npy")}
    assert set(got) == {"a.png.npy", "b.png.npy", "comparison/COMP_a.png.npy"}
    assert got["a.png.npy"][20, 20] == 200 and got["a.png.npy"][0, 0] == 0 and not got["b.png.npy"].any()
    assert got["comparison/COMP_a.png.npy"].shape == (256, 512)


def test_stream_upsert(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "filename string, seq bigint, v string"
    spark.createDataFrame([("a", 1, "1"), ("b", 2, "1"), ("a", 3, "2")], schema).coalesce(1).write.parquet(source)
    stream = lambda: incremental.new_rows(spark, source, spark.createDataFrame([], schema).schema)
    incremental.upsert_stream(stream(), target, "filename", "seq", mark).awaitTermination()
    spark.createDataFrame([("b", 4, "3"), ("c", 5, "3")], schema).coalesce(1).write.mode("append").parquet(source)
    incremental.upsert_stream(stream(), target, "filename", "seq", mark).awaitTermination()
    place, number = incremental.current(spark, target)
    assert number == 1 and {(r["filename"], r["v"]) for r in spark.read.parquet(place).collect()} == {("a", "2"), ("b", "3"), ("c", "3")}
    incremental.upsert_stream(stream(), target, "filename", "seq", mark).awaitTermination()
    assert incremental.current(spark, target)[1] == 1  # nothing new


def test_environment(spark, tmp_path):
    got = {r["name"]: r["ok"] for r in environment.healthcheck(spark, (str(tmp_path / "new"),)).collect()}
    assert got["spark"] and got[str(tmp_path / "new")]
    assert environment.configuration(spark).filter("name = 'target'").first()["value"] == "65"
    assert environment.find_binary("surely-not-there") is None


def test_schemas():
    assert [len(report_schema(n).fields) for n in (2, 3, 7)] == [17, 58, 87]


def test_every_query_runs(spark, small):
    found = catalog.queries()
    assert set(catalog.oracle_sql()) <= set(found)
    for name, query in found.items():
        assert query(spark, small).count() >= 0, name


def test_entry(spark, small):
    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
