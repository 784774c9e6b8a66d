"""File listings as tables: videos, images, reference banks, latest reports, names that carry columns."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import pose_in_name, safe_path, shot_in_name, stem, suffix
from ..functions.spelling import base_name
from ..params import ExtractParams


def listing(spark: SparkSession, root: str, suffixes: tuple[str, ...], recursive: bool) -> DataFrame:
    """``path``, ``filename`` (relative to ``root``), ``length`` and ``modified`` of the files with a suffix, case aside.

    Only metadata columns of the binary source are read; contents stay on disk until asked for.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
    folder = root.rstrip("/") + "/"
    relative = F.regexp_replace(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), r"^(file|hdfs|s3a?|abfss?):/{0,2}(?=/)", "")
    named = files.select("path", relative.alias("__p"), "length", F.col("modificationTime").alias("modified"))
    named = named.withColumn("filename", F.when(F.col("__p").startswith(folder), F.substr(F.col("__p"), F.lit(len(folder) + 1))).otherwise(base_name(F.col("__p"))))
    return named.filter(suffix(F.col("filename")).isin(*suffixes)).select("path", "filename", "length", "modified")


def videos(spark: SparkSession, root: str, p: ExtractParams = ExtractParams()) -> DataFrame:
    """Videos of one folder, sorted by name."""
    return listing(spark, root, p.video_suffixes, False).orderBy("filename")


def images(spark: SparkSession, root: str, p: ExtractParams = ExtractParams()) -> DataFrame:
    """Images below a folder in case-folded order of their relative paths, with ``seq`` for that order."""
    from ..operators.ranks import global_row_number

    found = listing(spark, root, p.image_suffixes, True)
    return global_row_number(found, [F.lower("filename"), F.col("filename")], "seq")


def image_contents(spark: SparkSession, root: str) -> DataFrame:
    """``filename`` and ``content`` of the images below a folder, for the kernels of :mod:`lumisift.functions.kernels`."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(base_name(F.col("path")).alias("filename"), "content")


def reference_images(spark: SparkSession, root: str, first: int = 20, suffixes: tuple[str, ...] = ("jpg", "png", "webp")) -> DataFrame:
    """The first images of a reference folder by path."""
    return listing(spark, root, suffixes, False).orderBy("path").limit(first)


def latest_report(spark: SparkSession, folder: str, step: int) -> str | None:
    """Path of the newest ``step<N>_dataset_report*.csv`` of a folder, None without one."""
    if not any(Path(folder).glob(f"step{step}_dataset_report*.csv")) and "://" not in folder:
        return None
    rows = spark.read.format("binaryFile").option("pathGlobFilter", f"step{step}_dataset_report*.csv").load(folder).agg(F.max_by("path", F.struct("modificationTime", "path"))).first()
    return rows[0] if rows else None


def resolve(frames: DataFrame, filename: str, roots: list[DataFrame]) -> DataFrame:
    """``source``: the path of each safe file name in the first root that lists it; null for unsafe or missing ones."""
    out = frames.withColumn("__safe", safe_path(F.col(filename)))
    found = []
    for i, root in enumerate(roots):
        out = out.join(root.select(F.col("filename").alias("__safe"), F.col("path").alias(f"__p{i}")).dropDuplicates(["__safe"]), "__safe", "left")
        found.append(F.col(f"__p{i}"))
    return out.withColumn("source", F.coalesce(*found) if found else F.lit(None).cast("string")).drop("__safe", *[f"__p{i}" for i in range(len(roots))])


def name_columns(files: DataFrame, filename: Column | str = "filename") -> DataFrame:
    """Shot type and pose bucket read from file names."""
    name = F.col(filename) if isinstance(filename, str) else filename
    return files.withColumn("shot_type", shot_in_name(name)).withColumn("pose_bucket", pose_in_name(name, "OTHER"))


def first_existing(candidates: list[str]) -> str | None:
    """First existing folder of a cascade of defaults, on the driver."""
    return next((c for c in candidates if Path(c).is_dir()), None)
