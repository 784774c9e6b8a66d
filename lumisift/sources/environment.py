"""Environment report: versions, folders and optional binaries."""

from __future__ import annotations

import os
import platform
import shutil
from importlib import metadata
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..params import pipeline_config


def find_binary(name: str, explicit: str | None = None, folders: tuple[str, ...] = ()) -> str | None:
    """A program by explicit path, search path, FFMPEG_DIR or known folders."""
    if explicit and Path(explicit).is_file():
        return explicit
    known = [f for f in (os.environ.get("FFMPEG_DIR"), *folders) if f]
    return shutil.which(name) or next((str(Path(f) / name) for f in known if (Path(f) / name).is_file()), None)


def healthcheck(spark: SparkSession, folders: tuple[str, ...] = ()) -> DataFrame:
    """One row per check: name, ok, detail. Missing folders are made; a folder counts as ok when a file can be written there."""
    rows = [("python", True, platform.python_version()), ("spark", True, spark.version)]
    for package in ("pyarrow", "pandas", "numpy"):
        try:
            rows.append((package, True, metadata.version(package)))
        except metadata.PackageNotFoundError:
            rows.append((package, False, "not installed"))
    gpu = shutil.which("nvidia-smi")
    rows.append(("gpu", gpu is not None, gpu or "no driver found; models run on the CPU"))
    for package in ("torch", "cv2", "mediapipe", "transformers"):
        rows.append((package, find_spec(package) is not None, "optional, for measured columns"))
    for binary in ("ffmpeg", "ffprobe"):
        found = find_binary(binary)
        rows.append((binary, found is not None, found or "not found"))
    for folder in folders:
        try:
            Path(folder).mkdir(parents=True, exist_ok=True)
            probe = Path(folder) / ".probe"
            probe.write_text("ok")
            probe.unlink()
            rows.append((folder, True, "writable"))
        except OSError as e:
            rows.append((folder, False, str(e)))
    return spark.createDataFrame(rows, "name string, ok boolean, detail string")


def configuration(spark: SparkSession) -> DataFrame:
    """All default parameters as step, name, value."""
    rows = [(step, name, str(value)) for step, params in pipeline_config().items() for name, value in vars(params).items()]
    return spark.createDataFrame(rows, "step string, name string, value string")
