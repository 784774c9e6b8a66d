"""Command line: run a step, or all of them, on CSV reports and folders. ``python -m lumisift gate --report in.csv --output out``"""

from __future__ import annotations

import argparse
import os
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import params
from .operators import merge, sampling
from .operators import reports as summaries
from .plans import pipeline
from .session import cut_lineage, get_session
from .sources import environment, files, media, reports, sinks

#: Step name: number, function, parameters and the other flags it takes.
STEPS = {
    "metrics": (2, pipeline.metrics_step, None, ()),
    "gate": (3, pipeline.gate_step, params.GateParams(), ("as_on_disk",)),
    "pose": (4, pipeline.pose_step, params.PoseParams(), ("all_images",)),
    "dedup": (5, pipeline.dedup_step, params.DedupParams(), ()),
    "identity": (6, pipeline.identity_step, params.IdentityParams(), ("all_eligible",)),
    "select": (7, pipeline.select_step, params.SelectionParams(), ()),
}
#: What a person may want to look at after a step: the files, under telling names.
REVIEWS = {"gate": sinks.category_review, "pose": sinks.pose_review, "dedup": sinks.cluster_review, "identity": sinks.identity_review, "select": sinks.ranked_candidates}
#: Target shares in per cent of the review of the selection.
REVIEW_TARGETS = {"CLOSE_UP": 18.0, "UPPER_BODY": 62.0, "FULL_BODY": 20.0}
ATTRIBUTES = ("expression_desc", "clothing_desc", "hair_desc", "bg_desc", "lighting_desc")


def _flags(s: argparse.ArgumentParser, defaults) -> None:
    for f in fields(defaults) if defaults else ():
        value, flag = getattr(defaults, f.name), f"--{f.name.replace('_', '-')}"
        if isinstance(value, bool):
            s.add_argument(flag, action="store_true", default=value)
        elif isinstance(value, (int, float, str)):
            s.add_argument(flag, type=type(value), default=value)


def parser() -> argparse.ArgumentParser:
    """One subcommand per step; every single-valued parameter is a flag with its default."""
    p = argparse.ArgumentParser(prog="lumisift", description=__doc__)
    sub = p.add_subparsers(dest="step", required=True)
    sub.add_parser("healthcheck").add_argument("--folder", action="append", default=[])

    def step(name: str, defaults=None, **needed: str) -> argparse.ArgumentParser:
        s = sub.add_parser(name)
        for flag, text in needed.items():
            s.add_argument(f"--{flag.replace('_', '-')}", required=True, help=text)
        s.add_argument("--limit", type=int, default=0, help="first rows only; 0 means all")
        s.add_argument("--many-files", action="store_true", help="keep the partitions of a large report instead of writing one file")
        s.add_argument("--one-line-rows", action="store_true", help="no field of a report holds a line break, so that large files can be split")
        _flags(s, defaults)
        return s

    s = step("extract", params.ExtractParams(), input="folder of videos", output="folder of frames and of the report")
    s.add_argument("--flat", action="store_true", help="all frames in one folder")
    s.add_argument("--overwrite", action="store_true", help="extract frames that exist again")
    s.add_argument("--ffmpeg")
    s.add_argument("--ffprobe")
    for name, (_, _, defaults, switches) in STEPS.items():
        s = step(name, defaults, report="report of the step before", output="folder of the new report")
        s.add_argument("--images", help="folder of the pictures, for --review")
        if name in REVIEWS:
            s.add_argument("--review", help="folder to which pictures are copied for a look")
        for switch in switches:
            s.add_argument(f"--{switch.replace('_', '-')}", action="store_true")
    s = step("review", candidates="folder of ranked candidates", selected="folder of the selection")
    s.add_argument("--target-count", type=int, default=45)
    s.add_argument("--populate-defaults", action="store_true", help="fill an empty selection with the first candidates")
    s = step("restore", params.RestorationParams(), report="report of step 7", output="folder of the new report")
    s.add_argument("--measures", help="CSV of filename, identity_sim_before, identity_sim_after, fidelity_to_orig; without it nothing is restored")
    s = step("package", params.PackagingParams(), pictures="CSV of filename, width, height and the five descriptions", report="report of step 7", output="folder of report, captions, records and guide")
    s.add_argument("--restored", help="report of step 9")
    s = step("all", report="report with all measured columns", output="folder of one folder per step")
    s.add_argument("--measures")
    s.add_argument("--pictures")
    return p


def _given(args: argparse.Namespace, defaults):
    return replace(defaults, **{f.name: getattr(args, f.name) for f in fields(defaults) if hasattr(args, f.name)})


def _read(spark: SparkSession, path: str, args: argparse.Namespace) -> DataFrame:
    report = reports.read_report(spark, path, 7, line_breaks=not args.one_line_rows)
    for c in ("global_hash", "face_hash"):
        report = report.withColumn(c, F.col(c).try_cast("bigint")) if c in report.columns else report
    report = report.withColumn("seq", F.monotonically_increasing_id()) if "seq" not in report.columns else report.withColumn("seq", F.col("seq").cast("bigint"))
    return report.orderBy("seq").limit(args.limit) if args.limit > 0 else report


def _write(rows: DataFrame, path: str, args: argparse.Namespace, order: list[str] | None = None) -> None:
    reports.write_or_beside(rows, path, [c for c in rows.columns if c != "seq"], order, single_file=not args.many_files)


def _step(spark: SparkSession, args: argparse.Namespace, name: str, report: DataFrame, output: str) -> DataFrame:
    _, run, defaults, switches = STEPS[name]
    kwargs = {s: getattr(args, s, False) for s in switches}
    if defaults:
        kwargs["p"] = _given(args, defaults)
    out = cut_lineage(run(report, **kwargs))
    _write(out, output, args, ["seq"])
    if getattr(args, "review", None):
        sinks.copy_files(REVIEWS[name](out), args.images or ".", args.review)
    return out


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """Step 1: plan the frames of every video of a folder, extract those that are missing, report."""
    p = _given(args, params.ExtractParams())
    ffmpeg, ffprobe = (environment.find_binary(n, getattr(args, n)) for n in ("ffmpeg", "ffprobe"))
    if not ffmpeg:
        raise SystemExit("ffmpeg was not found; name it by --ffmpeg")
    found = files.videos(spark, args.input, p).select(F.regexp_replace("path", "^file:/*", "/").alias("video"))
    found = found.limit(args.limit) if args.limit > 0 else found
    probed = media.ffprobe_json(ffprobe)(F.col("video")) if ffprobe else F.lit(None).cast("string")
    durations = cut_lineage(found.select("video", media.duration(probed, F.lit(None).cast("double"), F.lit(None).cast("double")).alias("duration_sec")))
    planned = sampling.frame_plan(durations, p=p)
    planned = planned.withColumn("target", F.col("frame") if args.flat else F.concat_ws("/", files.stem(F.col("video")), "frame"))
    done = files.images(spark, args.output, p).select(F.col("filename").alias("target")) if os.path.isdir(args.output) else spark.createDataFrame([], "target string")
    todo = merge.skip_existing(planned, done, "target", args.overwrite)
    made = cut_lineage(media.extract_frames(todo, [media.ffmpeg_frame(ffmpeg)]).join(planned.select("video", "frame", "target"), ["video", "frame"]))
    sinks.write_files(made, args.output, "target", "content")
    had = planned.join(todo.select("target"), "target", "left_anti").select("video", F.lit(b"").alias("content"))
    _write(media.extract_report(made.select("video", "content").unionByName(had), planned, durations), f"{args.output}/step1_extract_report", args, ["video"])


def review(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Step 8: fill an empty selection if asked to, and show its shares against the targets."""
    os.makedirs(args.selected, exist_ok=True)
    listed = lambda folder: files.images(spark, folder).select("filename").withColumn("name", F.col("filename"))
    if args.populate_defaults:
        chosen = sinks.populate_selected(listed(args.candidates), listed(args.selected), "name", args.target_count)
        sinks.copy_files(chosen.select(F.col("filename").alias("source"), F.element_at(F.split("filename", "/"), -1).alias("target")), args.candidates, args.selected)
    shares = summaries.ratio_against_target(files.name_columns(listed(args.selected)), "shot_type", REVIEW_TARGETS)
    shares.show(truncate=False)
    return shares


def restore(spark: SparkSession, args: argparse.Namespace, report: DataFrame, output: str) -> DataFrame:
    """Step 9 on the selected rows of a report and the measures of a restoration."""
    measures = ("identity_sim_before", "identity_sim_after", "fidelity_to_orig")
    chosen = report.filter(F.coalesce("candidate_selected", F.lit(False))).drop(*measures)
    if args.measures:
        given = spark.read.option("header", True).csv(args.measures).select("filename", *[F.col(c).try_cast("double").alias(c) for c in measures]).dropDuplicates(["filename"])
        chosen = chosen.join(given, "filename", "left")
    else:
        chosen = chosen.withColumns({c: F.lit(None).cast("double") for c in measures})
    out = pipeline.restore_step(chosen, _given(args, params.RestorationParams()), bool(args.measures), keep=("seq",))
    _write(out, output, args, ["seq"])
    return out


def package(spark: SparkSession, args: argparse.Namespace, report: DataFrame, restored: DataFrame | None, output: str) -> None:
    """Step 10: the report, a caption beside every picture, JSON lines and the guide."""
    p = _given(args, params.PackagingParams())
    raw = spark.read.option("header", True).csv(args.pictures)
    pictures = raw.select("filename", *[F.col(c).try_cast("int").alias(c) for c in ("width", "height")], *[F.col(c) if c in raw.columns else F.lit("").alias(c) for c in ATTRIBUTES])
    restored = report.select("filename", "seq", F.lit("untouched_raw_camera").alias("restoration_status")) if restored is None else restored
    out = cut_lineage(pipeline.package_step(pictures, report, restored, p))
    _write(out, f"{output}/report", args, ["final_filename"])
    sinks.write_files(sinks.caption_files(out), f"{output}/captions", "target", "text")
    sinks.write_json_lines(out, f"{output}/metadata")
    sinks.write_files(sinks.training_guide(out, p).withColumn("name", F.lit("TRAINING_GUIDE.md")), output, "name", "value")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = get_session("lumisift")
    if args.step == "healthcheck":
        environment.healthcheck(spark, tuple(args.folder)).show(truncate=False)
    elif args.step == "extract":
        extract(spark, args)
    elif args.step == "review":
        review(spark, args)
    elif args.step in STEPS:
        _step(spark, args, args.step, _read(spark, args.report, args), args.output)
    elif args.step == "restore":
        restore(spark, args, _read(spark, args.report, args), args.output)
    elif args.step == "package":
        package(spark, args, _read(spark, args.report, args), _read(spark, args.restored, args) if args.restored else None, args.output)
    else:
        report = _read(spark, args.report, args)
        for name, (number, *_) in STEPS.items():
            report = _step(spark, args, name, report, f"{args.output}/step{number}")
        restored = restore(spark, args, report, f"{args.output}/step9")
        if args.pictures:
            package(spark, args, report, restored, f"{args.output}/step10")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
