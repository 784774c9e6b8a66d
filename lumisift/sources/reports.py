"""CSV reports: reading with typed columns, writing in the fixed column order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import report_schema


def read_report(spark: SparkSession, path: str, step: int | None = None, schema: T.StructType | None = None, line_breaks: bool = True) -> DataFrame:
    """A UTF-8 report with header, quoted line breaks and a byte order mark; empty fields are null.

    Columns named in the schema are cast (a value that cannot be cast becomes null), ``;`` lists become arrays; other columns
    stay strings. ``filename`` must be there. A file is one task where fields may hold ``line_breaks``; without them large files are split.
    """
    raw = spark.read.option("header", True).option("multiLine", line_breaks).option("escape", '"').option("encoding", "UTF-8").option("nullValue", "").csv(path)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    require(raw, ["filename"])
    wanted = {f.name: f.dataType for f in (schema or report_schema(step or 7)).fields}
    out = []
    for c in raw.columns:
        kind = wanted.get(c)
        if isinstance(kind, T.ArrayType):
            out.append(F.when(F.col(c).isNotNull(), F.split(c, ";")).alias(c))
        elif kind is not None and not isinstance(kind, T.StringType):
            out.append(F.col(c).try_cast(kind).alias(c))
        else:
            out.append(F.col(c))
    return raw.select(*out)


def require(rows: DataFrame, columns: list[str]) -> None:
    """Raise where a required column is missing."""
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def as_text(rows: DataFrame) -> DataFrame:
    """Columns as a CSV report shows them: booleans in lower case, arrays joined by ``;``."""
    out = []
    for f in rows.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            out.append(F.concat_ws(";", F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            out.append(F.lower(F.col(f.name).cast("string")).alias(f.name))
        else:
            out.append(F.col(f.name))
    return rows.select(*out)


def stamped(path: str, when: datetime) -> str:
    """A name beside ``path`` with a time stamp before its suffix, for a target that cannot be replaced."""
    head, dot, tail = path.rstrip("/").rpartition(".")
    stamp = when.strftime("_%Y%m%d_%H%M%S")
    return f"{head}{stamp}.{tail}" if dot and "/" not in tail else f"{path.rstrip('/')}{stamp}"


def write_or_beside(rows: DataFrame, path: str, columns: list[str], order: list[str] | None = None, single_file: bool = False) -> str:
    """:func:`write_report`; where the target cannot be replaced, under a stamped name beside it. Returns the path written."""
    try:
        write_report(rows, path, columns, order, single_file)
        return path
    except Exception as e:  # noqa: BLE001 - only a refused target is worked around
        if not any(word in str(e) for word in ("Permission denied", "AccessControl", "Unable to clear output directory", "Mkdirs failed")):
            raise
        beside = stamped(path, datetime.now())
        write_report(rows, beside, columns, order, single_file)
        return beside


def write_report(rows: DataFrame, path: str, columns: list[str], order: list[str] | None = None, single_file: bool = False) -> None:
    """CSV with exactly ``columns`` (missing ones empty, others left out). The commit protocol makes the files appear at once.

    ``single_file`` is for small reports that a person opens; large ones keep their partitions, range-sorted by ``order``.
    """
    shown = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in dict.fromkeys([*columns, *(order or [])])])
    shown = shown.orderBy(*order) if order else shown
    shown = as_text(shown).select(*columns)
    if single_file:
        shown = shown.coalesce(1)
    shown.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
