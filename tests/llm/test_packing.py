import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumisift.llm import packing


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30), max_size=12))
def test_patterns_use_every_item_once(histogram):
    used = Counter()
    for times, use in packing.plan_patterns(histogram, 40):
        assert times >= 1 and sum(k * n for k, n in use.items()) <= 40
        for k, n in use.items():
            used[k] += n * times
    assert used == Counter({k: v for k, v in histogram.items() if v})


def test_one_container_is_filled_as_far_as_possible():
    rnd = random.Random(6)
    for _ in range(200):
        items = [rnd.randrange(1, 30) for _ in range(rnd.randrange(1, 9))]
        counts = Counter(items)
        use = packing.fill_one(counts, sorted(counts, reverse=True), 60)
        got = sum(k * n for k, n in use.items())
        rest = list(items)
        rest.remove(max(items))
        sums = {0}
        for x in rest:
            sums |= {s + x for s in sums}
        assert got == max(items) + max(s for s in sums if s <= 60 - max(items))
        assert all(n <= counts[k] for k, n in use.items())


@pytest.mark.parametrize("numbered", [200_000, 3])
def test_table(spark, monkeypatch, numbered):
    monkeypatch.setattr(packing, "NUMBERED_ROWS", numbered)
    rnd = random.Random(7)
    rows = [(i, rnd.choice([5, 17, 33, 60, rnd.randrange(1, 100)])) for i in range(300)] + [(900, 0), (901, None), (902, 350), (903, 300), (None, 7), (5, 5), (5, 5)]
    df = spark.createDataFrame(rows, "id bigint, n bigint").withColumns({"bucket": F.lit(0), "length": F.lit(1), "number": F.lit("x"), "piece": F.lit(2)})
    got = packing.pack(df, "id", "n", 100).collect()
    fill, pieces = Counter(), Counter()
    for r in got:
        if r["container"] is not None:
            fill[r["container"]] += r["length"]
        pieces[r["id"]] += 1
    assert max(fill.values()) <= 100 and set(fill) == set(range(len(fill)))
    assert sum(fill.values()) == sum(n or 0 for _, n in rows)
    assert pieces[902] == 4 and pieces[903] == 3 and pieces[5] == 3 and len(got) == len(rows) + 3 + 2
    assert all(r["container"] is None for r in got if r["id"] in (900, 901))
    assert sorted((r["piece"], r["start"], r["length"]) for r in got if r["id"] == 902) == [(0, 0, 100), (1, 100, 100), (2, 200, 100), (3, 300, 50)]
    assert len(fill) <= 1.05 * sum(fill.values()) / 100  # few different lengths, so not every container can be full
    report = packing.container_report(spark.createDataFrame(got, "id bigint, piece bigint, start bigint, length bigint, container bigint"), 100).first()
    assert report["containers"] == len(fill) and report["fullest"] <= 100


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "id bigint, n bigint"), "id", "n", 10).collect() == []
