"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low: float, high: float) -> Column:
    """``x`` held between two bounds; null stays null."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def guarded_ratio(x: Column, y: Column, floor: float) -> Column:
    """``x / max(y, floor)``."""
    return x / F.greatest(y, F.lit(floor))


def align_up_down(x: Column, multiple: int = 16) -> Column:
    """Nearest multiple, halves upward, at least one multiple."""
    return F.greatest(F.floor((x + multiple / 2) / multiple) * multiple, F.lit(multiple)).cast("int")


def quantised(x: Column, digits: int) -> Column:
    """``floor(x * 10^digits + 0.5)`` as a long, the same in every engine; null and NaN give null."""
    return F.when(x.isNotNull() & ~F.isnan(x), F.floor(x * float(10**digits) + 0.5).cast("bigint"))


def hamming(a: Column, b: Column) -> Column:
    """Different bits of two longs."""
    return F.bit_count(a.bitwiseXOR(b))


def angle_gap(yaw_a: Column, pitch_a: Column, yaw_b: Column, pitch_b: Column, missing: float = 999.0) -> Column:
    """Straight distance in yaw and pitch; ``missing`` where a part is null."""
    return F.coalesce(F.hypot(yaw_a - yaw_b, pitch_a - pitch_b), F.lit(missing))


def sign_hash(values: Column, median_from: int = 8) -> Column:
    """64-bit hash of an array of 64: bit i is set where value i exceeds the median of the values from ``median_from`` on."""
    xs = F.transform(values, lambda x: x.cast("double"))
    tail = F.array_sort(F.slice(xs, median_from + 1, 64 - median_from))
    n = 64 - median_from
    median = (F.element_at(tail, n // 2) + F.element_at(tail, n // 2 + 1)) / 2 if n % 2 == 0 else F.element_at(tail, n // 2 + 1)
    bits = F.transform(xs, lambda x: F.when(x > median, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(F.reverse(bits), F.lit(0).cast("bigint"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays, in array order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 1e-12) -> Column:
    """Cosine of two arrays; a zero vector has cosine 0."""
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(eps))
