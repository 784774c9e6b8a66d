"""Sinks: partitioned manifests instead of copied files, JSON lines, captions, guides."""

from __future__ import annotations

import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import blend, comparison_strip, lanczos
from ..functions.names import base_name, candidate_name, one_decimal
from ..params import PackagingParams


def partitioned_manifest(rows: DataFrame, by: str, path: str, columns: list[str]) -> None:
    """``columns`` of the rows in one folder per value of ``by``; replaces what was there."""
    rows.select(by, *[c for c in columns if c != by]).write.mode("overwrite").partitionBy(by).parquet(path)


def copy_manifest(rows: DataFrame, source: Column, folder: Column, name: Column) -> DataFrame:
    """``source`` and ``target`` of every file to be copied."""
    return rows.select(source.alias("source"), F.concat_ws("/", folder, name).alias("target"))


def category_review(rows: DataFrame) -> DataFrame:
    """Frames by gate category."""
    return copy_manifest(rows, F.col("filename"), F.col("face_gate_category"), F.col("filename"))


def pose_review(rows: DataFrame) -> DataFrame:
    bucket = F.col("pose_bucket")
    return copy_manifest(rows.filter(bucket.isNotNull()), F.col("filename"), bucket, F.concat_ws("_", bucket, base_name(F.col("filename"))))


def representatives(rows: DataFrame) -> DataFrame:
    """The best frame of each cluster as ``{shot}_{pose}_{name}``."""
    kept = rows.filter(F.col("duplicate_status").isin("representative", "unique"))
    return copy_manifest(kept, F.col("filename"), F.lit("representatives"), F.concat_ws("_", F.coalesce("shot_type", F.lit("UNKNOWN")), F.coalesce("pose_bucket", F.lit("UNKNOWN")), base_name(F.col("filename"))))


def cluster_review(rows: DataFrame) -> DataFrame:
    """Members of clusters of two or more as ``WINNER_``/``DUP_q{score}_eye{eye}_{name}``."""
    kept = rows.filter("group_size > 1")
    role = F.when(F.col("duplicate_status") == "representative", "WINNER").otherwise("DUP")
    name = F.format_string("%s_q%.1f_eye%.1f_%s", role, one_decimal(F.coalesce("face_quality_score", F.lit(0.0))), one_decimal(F.coalesce("eye_sharpness", F.lit(0.0))), base_name(F.col("filename")))
    return copy_manifest(kept, F.col("filename"), F.col("duplicate_group"), name)


def identity_review(rows: DataFrame) -> DataFrame:
    name = F.format_string("sim%.4f_%s", F.floor(F.col("identity_similarity_mean") * 10000 + 0.5) / 10000, base_name(F.col("filename")))
    return copy_manifest(rows.filter("identity_class is not null"), F.col("filename"), F.col("identity_class"), name)


def ranked_candidates(rows: DataFrame) -> DataFrame:
    """Selected candidates in three layouts (all, by shot, by pose) from one pass."""
    kept = rows.filter("candidate_selected")
    name = candidate_name(F.col("candidate_rank"), F.col("lora_candidate_score"), F.coalesce("shot_type", F.lit("UPPER_BODY")), F.coalesce("pose_bucket", F.lit("FRONT")), base_name(F.col("filename")))
    folders = F.array(F.lit("all_ranked"), F.concat(F.lit("by_shot/"), F.coalesce("shot_type", F.lit("UPPER_BODY"))), F.concat(F.lit("by_pose/"), F.coalesce("pose_bucket", F.lit("FRONT"))))
    return kept.select(F.col("filename").alias("source"), F.explode(folders).alias("folder"), name.alias("name")).select("source", F.concat_ws("/", "folder", "name").alias("target"))


def populate_selected(candidates: DataFrame, selected: DataFrame, name: str = "name", first: int = 45) -> DataFrame:
    """The first candidates by name, only where nothing is selected yet."""
    nothing = selected.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(1).alias("one"))
    return candidates.orderBy(name).limit(first).withColumn("one", F.lit(1)).join(F.broadcast(nothing), "one", "left_semi").drop("one")


def caption_files(rows: DataFrame) -> DataFrame:
    """``target`` and ``text`` of the caption file beside every packaged picture."""
    return rows.select(F.regexp_replace("final_filename", r"\.[^.]*$", ".txt").alias("target"), F.col("flux_caption").alias("text"))


def metadata_json(rows: DataFrame) -> DataFrame:
    """One JSON object per packaged picture, characters unescaped, empty values kept."""
    record = F.struct(
        F.col("final_filename").alias("image"), F.col("flux_caption").alias("text"), F.col("tags_caption").alias("tags"), F.col("aligned_width").alias("width"),
        F.col("aligned_height").alias("height"), F.col("shot_type"), F.col("pose_bucket").alias("pose"), F.col("restoration_status").alias("restoration"),
    )
    return rows.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(rows: DataFrame, path: str) -> None:
    metadata_json(rows).write.mode("overwrite").text(path)


# Recommended settings of a training run and templates of prompts, as the guide lists them.
TRAINING = (
    ("Network", "LoRA, linear and attention layers"), ("Rank", "16 or 32"), ("Alpha", "16"), ("Learning rate", "1e-4 to 2e-4, cosine"), ("Batch size", "1, or 2 accumulated"), ("Resolution", "up to 1024 or 1536, aspect-ratio buckets"),
    ("Steps", "1,500 to 2,200"), ("Text encoder rate", "0.0, or 5e-5 for CLIP only"),
)
PROMPTS = (
    ("Portrait", "upper body portrait, gentle smile, elegant dress, hotel lobby, cinematic light"),
    ("Outdoors", "full body shot, walking along a sunny street, casual clothes, natural skin texture"),
    ("Close-up", "extreme close-up portrait, looking into the camera, soft studio light, natural skin pores"),
)


def training_guide(rows: DataFrame, p: PackagingParams = PackagingParams()) -> DataFrame:
    """A one-row guide to the packaged set in Markdown: contents, caption rules, settings of a training run, prompts."""
    one = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("shot_type") == s).alias(s) for s in ("CLOSE_UP", "UPPER_BODY", "FULL_BODY")])
    text = "# Training set of %s\n\n## Contents\n- Pictures: %d\n- Close-ups: %d, upper body: %d, full body: %d\n- Sides are multiples of %d\n\n## Captions\nEvery caption names clothing, hair, expression, background and light, so that only the subject binds to the trigger word.\n"
    return one.select(F.concat(F.format_string(text, F.lit(p.trigger), "n", "CLOSE_UP", "UPPER_BODY", "FULL_BODY", F.lit(p.multiple)), F.lit(guide_rest(p.trigger))).alias("value"))


def guide_rest(trigger: str) -> str:
    """The parts of the guide that do not depend on the pictures."""
    settings = "\n## Training\n| Setting | Value |\n|---|---|\n" + "".join(f"| {k} | {v} |\n" for k, v in TRAINING)
    return settings + "\n## Prompts\n" + "".join(f"- {k}: photo of {trigger}, a young woman, {v}\n" for k, v in PROMPTS)


def write_files(rows: DataFrame, folder: str, name: str, content: str) -> None:
    """One file per row below a folder that all executors share; rows without content are passed over."""

    def each(part):
        for row in part:
            if row[content] is not None:
                target = Path(folder) / row[name]
                target.parent.mkdir(parents=True, exist_ok=True)
                data = row[content]
                target.write_bytes(data.encode() if isinstance(data, str) else bytes(data))

    rows.select(name, content).foreachPartition(each)


def copy_files(manifest: DataFrame, source_root: str, target_root: str) -> None:
    """Copy what a manifest (``source``, ``target``) lists from one shared folder to another; a source that is not there is passed over."""

    def each(part):
        for row in part:
            source, target = Path(source_root) / row["source"], Path(target_root) / row["target"]
            if source.is_file():
                target.parent.mkdir(parents=True, exist_ok=True)
                shutil.copy2(source, target)

    manifest.select("source", "target").foreachPartition(each)


def write_crops(rows: DataFrame, crop: Callable, writer: Callable) -> None:
    """Write what ``crop(row)`` gives by ``writer(row, data)``, partition by partition."""

    def each(part):
        for row in part:
            data = crop(row)
            if data is not None:
                writer(row, data)

    rows.foreachPartition(each)


def write_restored(rows: DataFrame, pictures: Callable, writer: Callable) -> None:
    """Write the picture of every row after step 9, and a side-by-side strip of what was restored.

    ``pictures(row)`` gives (picture, its face crop, the restored crop, (x, y) of the crop); the crops are None where nothing was tried. Only rows of status
    ``safely_restored`` get the restored crop, blended in; all others keep their picture. ``writer(name, pixels)`` encodes and stores one file.
    """

    def each(part):
        for row in part:
            picture, crop, restored, at = pictures(row)
            name = row["filename"].replace("\\", "/").rsplit("/", 1)[-1]
            if row["restoration_status"] == "safely_restored" and restored is not None:
                h, w = crop.shape[:2]
                writer(name, blend(picture, lanczos(restored, h, w), *at))
                writer(f"comparison/COMP_{name}", comparison_strip(crop, restored))
            else:
                writer(name, picture)

    rows.foreachPartition(each)
