"""Problem 7: filling fixed-capacity containers by minimum bin slack over the multiset of lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Items of one length that are numbered together.
NUMBERED_ROWS = 200_000


def fill_one(counts: dict[int, int], lengths: list[int], capacity: int) -> dict[int, int]:
    """Use counts of the lengths that fill one container closest to ``capacity``, the longest remaining item included.

    Subset sums are bits of an integer; each length enters in powers of two of its count, so a length with a million items adds few steps.
    The search stops as soon as the container can be filled exactly; the counts are read off backwards.
    """
    longest = lengths[0]
    target = capacity - longest
    sums, steps = 1, []
    goal = 1 << target
    for length in lengths:
        if length > target:
            continue
        left = min(counts[length] - (length == longest), target // length)
        power = 1
        while left > 0 and not sums & goal:
            take = min(power, left)
            steps.append((length, take, sums))
            sums |= sums << (length * take)
            left -= take
            power *= 2
        if sums & goal:
            break
    at = (sums & ((goal << 1) - 1)).bit_length() - 1
    use = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            use[length] = use.get(length, 0) + take
            at -= length * take
    return use


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns (times, uses of each length) that pack the whole multiset of lengths 1..capacity.

    A pattern is used as often as the remaining counts allow, so the work depends on the number of different lengths and not of items.
    """
    counts = {int(k): int(v) for k, v in histogram.items() if v > 0}
    if any(k < 1 or k > capacity for k in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    lengths = sorted(counts, reverse=True)
    patterns = []
    while lengths:
        use = fill_one(counts, lengths, capacity)
        times = min(counts[k] // n for k, n in use.items())
        patterns.append((times, use))
        for k, n in use.items():
            counts[k] -= n * times
        lengths = [k for k in lengths if counts[k]]
    return patterns


def pack(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """Put every item into a container: ``key``, piece, start, length, container.

    Items longer than ``capacity`` are cut into full containers and one remainder (``piece`` 0, 1, ..; ``start`` is its offset); no other item is
    cut. Items of size 0 or null take no room: piece 0, length 0 and a null container. Repeated keys are items of their own.

    The driver plans on the histogram of lengths alone (at most ``capacity`` rows). Items get a number within their length, from counts per
    (length, hash bucket) and a window over one bucket, and find their pattern's container by that number, so that no container, length or
    table passes through one task.
    """
    held = cut_lineage(sizes.select(key, F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint").alias("n")))
    pieces = held.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.floor((F.col("n") - 1) / capacity), F.lit(0)))))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).withColumn("length", F.least(F.col("n") - F.col("start"), F.lit(capacity)))
    histogram = {r["length"]: r["count"] for r in pieces.filter("length > 0").groupBy("length").count().collect()}
    patterns = plan_patterns(histogram, capacity)
    rows, container, used = [], 0, {}
    for times, use in patterns:
        for length, n in use.items():
            rows.append((length, used.get(length, 0), n, container))
            used[length] = used.get(length, 0) + n * times
        container += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    span = max([1, *histogram.values()]) + 1
    keys = table[:, 0] * span + table[:, 1]  # by (length, first number)
    buckets = max(1, -(-max([1, *histogram.values()]) // NUMBERED_ROWS))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            length, number = pdf["length"].to_numpy(), pdf["number"].to_numpy()
            place = pd.array([pd.NA] * len(pdf), dtype="Int64")
            real = length > 0
            if real.any():
                row = table[np.searchsorted(keys, length[real] * span + number[real], side="right") - 1]
                place[real] = row[:, 3] + (number[real] - row[:, 1]) // row[:, 2]
            yield pdf.drop(columns=["number"]).assign(container=place)

    pieces = pieces.drop("n").withColumn("bucket", F.pmod(F.xxhash64(key, "piece"), F.lit(buckets)))
    sums = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("m"))
    sums = sums.select("length", "bucket", (F.sum("m").over(Window.partitionBy("length").orderBy("bucket")) - F.col("m")).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy(key, "piece")
    numbered = pieces.withColumn("number", F.row_number().over(inside) - 1).join(sums, ["length", "bucket"]).select(key, "piece", "start", "length", (F.col("number") + F.col("before")).alias("number"))
    kind = dict(sizes.dtypes)[key]
    return numbered.mapInPandas(assign, f"{key} {kind}, piece bigint, start bigint, length bigint, container bigint")


def container_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, items, tokens and the share of room left empty."""
    by = packed.filter("container is not null").groupBy("container").agg(F.sum("length").alias("filled"), F.count(F.lit(1)).alias("items"))
    return by.agg(F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("filled").alias("tokens"), F.max("filled").alias("fullest"), (1 - F.sum("filled") / (F.count(F.lit(1)) * capacity)).alias("empty_share"))
