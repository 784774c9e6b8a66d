"""Canonical spellings, paths and the first folder of a path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(text: Column) -> Column:
    """Letters and digits of ``text`` in lower case; null and texts without any give ``""``."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]", ""))


def is_blank(text: Column) -> Column:
    """True for null and for texts without a letter or digit."""
    return canonical(text) == ""


def posix_path(path: Column) -> Column:
    """Trimmed path with forward slashes only; null stays null."""
    return F.trim(F.translate(path, "\\", "/"))


def base_name(path: Column) -> Column:
    """Last segment of a path of either slash."""
    return F.trim(F.element_at(F.split(posix_path(path), "/"), -1))


def first_folder(path: Column) -> Column:
    """First named folder of a path; null if the path has no folder."""
    parts = F.filter(F.split(posix_path(path), "/"), lambda x: ~F.trim(x).isin("", ".", ".."))
    return F.when(F.size(parts) > 1, F.trim(F.get(parts, F.lit(0))))
