"""Session helpers: local sessions for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(app: str = "lumisift", cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LUMISIFT_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for ``DataFrame.checkpoint``.

    A cluster names it in ``spark.checkpoint.dir`` and that name is used. Only where the setting
    is missing (tests, local runs on one machine) is a folder made here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lumisift-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut_lineage(df):
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Used where a result is read several times or a loop would grow its plan; the files survive the
    loss of executors. Spark removes them once nothing refers to them where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, as in :func:`get_session`.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df):
    """Rows dealt out evenly where the input has fewer partitions than there are cores.

    For Python-heavy stages over few, small files; an input of many partitions, as at scale, is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
