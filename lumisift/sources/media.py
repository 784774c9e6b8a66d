"""Video durations and frames: what external probes give, and the contract of the extractor."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import stem


def duration(probe_json: Column, frame_count: Column, fps: Column) -> Column:
    """Seconds from a probe's JSON; else frames over rate; else 0."""
    probed = F.get_json_object(probe_json, "$.format.duration").try_cast("double")
    counted = F.when((frame_count > 0) & (fps > 0), frame_count / fps)
    return F.coalesce(F.when(probed > 0, probed), counted, F.lit(0.0))


def extract_frames(planned: DataFrame, extractors: list[Callable[[str, float], bytes | None]]) -> DataFrame:
    """Run extractors (the first that gives a picture wins) over planned frames: video, frame, content, error.

    Each extractor gets the video's path and the second; it is loaded with the task and called by Arrow batches. A failed frame keeps its row with an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for video, frame, t in zip(pdf["video"], pdf["frame"], pdf["t"]):
                content, error = None, "no extractor gave a picture"
                for f in extractors:
                    try:
                        content = f(video, t)
                    except Exception as e:  # noqa: BLE001 - the row keeps the message
                        error = str(e)
                    if content is not None:
                        error = None
                        break
                out.append((video, frame, content, error))
            yield pd.DataFrame(out, columns=["video", "frame", "content", "error"])

    return planned.select("video", "frame", "t").mapInPandas(run, "video string, frame string, content binary, error string")


def ffprobe_json(program: str, timeout: int = 60) -> Callable[[Column], Column]:
    """An Arrow UDF: what the probe program says of each video, as JSON; null where it fails."""

    @F.pandas_udf("string")
    def probe(paths: pd.Series) -> pd.Series:
        return pd.Series([_output([program, "-v", "error", "-print_format", "json", "-show_format", p], timeout, text=True) for p in paths], dtype="object")

    return probe


def ffmpeg_frame(program: str, timeout: int = 120) -> Callable[[str, float], bytes | None]:
    """An extractor that has the program write one PNG picture to its output."""
    return lambda video, t: _output([program, "-v", "error", "-ss", f"{t:.3f}", "-i", video, "-frames:v", "1", "-f", "image2pipe", "-vcodec", "png", "-"], timeout)


def _output(command: list[str], timeout: int, text: bool = False):
    try:
        done = subprocess.run(command, capture_output=True, timeout=timeout, text=text, check=False)
    except (OSError, subprocess.TimeoutExpired):
        return None
    return done.stdout if done.returncode == 0 and done.stdout else None


def extract_report(frames: DataFrame, planned: DataFrame, durations: DataFrame) -> DataFrame:
    """The step-1 report: video, duration_sec, frames_extracted, target_frames and output_folder, the video's stem; videos without a plan have 0."""
    made = frames.groupBy("video").agg(F.count("content").cast("int").alias("frames_extracted"))
    goal = planned.groupBy("video").agg(F.count(F.lit(1)).cast("int").alias("target_frames"))
    rows = durations.select("video", "duration_sec").join(made, "video", "left").join(goal, "video", "left").fillna(0, ["frames_extracted", "target_frames"])
    return rows.select("video", "duration_sec", "frames_extracted", "target_frames", stem(F.col("video")).alias("output_folder"))
