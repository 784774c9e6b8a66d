"""Incremental runs: new files only, upserts by micro-batch, bursts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import upsert


def new_rows(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """A stream over a folder of parquet files; the checkpoint of the query remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def upsert_stream(stream: DataFrame, target: str, key: str, seq: str, checkpoint: str, keep: int = 2):
    """Merge each micro-batch into a parquet report: new rows win, others stay. Returns the started query (available now, then ends).

    The merged report is written beside the old one under the batch's number, and a pointer names the current one, so that a repeated batch gives the same report. Of the merged
    reports the last ``keep`` stay, for readers that have opened one. A batch rewrites the report, so batches should be large.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = current(spark, target)
        fresh = batch.groupBy(key).agg(F.max_by(F.struct(*[c for c in batch.columns if c != key]), F.col(seq)).alias("r")).select(key, "r.*").select(*batch.columns)
        if done is not None and done[1] >= number:
            return
        merged = fresh if done is None else upsert(fresh, spark.read.parquet(done[0]), key, seq).drop("__part", "__order")
        place = f"{target}/batch={number:08d}"
        merged.write.mode("overwrite").parquet(place)
        drop_before(spark, target, number, keep)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drop_before(spark: SparkSession, target: str, number: int, keep: int) -> None:
    """Remove merged reports of batches up to ``number`` but the last ``keep`` of them."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")), key=lambda p: p.getName())
    for old in [p for p in found if int(p.getName().split("=")[1]) <= number][: -max(keep, 1)]:
        fs.delete(old, True)


def current(spark: SparkSession, target: str) -> tuple[str, int] | None:
    """Folder and number of the last complete merged report."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")]
    found = [p for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    if not found:
        return None
    last = max(found, key=lambda p: p.getName())
    return last.toString(), int(last.getName().split("=")[1])


def event_bursts(events: DataFrame, gap: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of a user's events with gaps up to ``gap``; works on streams (with a watermark) and on tables."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total")).select("user_id", F.col("w.start").alias("burst_start"), F.col("w.end").alias("burst_end"), "events", "total")
