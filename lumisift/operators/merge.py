"""Upsert-merge of reports and skipping of work already done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import last_wins


def upsert(new: DataFrame, old: DataFrame, key: str, seq: str) -> DataFrame:
    """All new rows in order, then old rows whose key was not rewritten (last duplicate wins), by lower-case key.

    Adds ``merge_order`` keys ``__part`` (0 new, 1 old) and ``__order`` for a sink that wants the order; columns missing on one side are null.
    """
    fresh = new.withColumn("__part", F.lit(0)).withColumn("__order", F.format_string("%020d", F.col(seq)))
    kept = last_wins(old, key, seq).join(new.select(key).distinct(), key, "left_anti").withColumn("__part", F.lit(1)).withColumn("__order", F.lower(key))
    return fresh.unionByName(kept, allowMissingColumns=True)


def skip_existing(planned: DataFrame, done: DataFrame, key: str, overwrite: bool = False) -> DataFrame:
    """Planned outputs that do not exist yet; all of them with ``overwrite``."""
    return planned if overwrite else planned.join(done.select(key).distinct(), key, "left_anti")
