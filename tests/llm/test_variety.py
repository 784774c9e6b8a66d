import math
import random

import pytest
from pyspark.sql import functions as F

from lumisift.llm import queries, variety


def points(n, seed=5):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["a", "b"]), round(rnd.gauss(0, 30), 2), round(rnd.gauss(0, 20), 2)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, g string, y double, p double").withColumns({"cluster": F.lit(9), "stratum": F.lit("s"), "mandatory": F.lit(0)})


def alone(rows, radius):
    return {i for i, g, y, p in rows if not any(j != i and h == g and math.hypot(y - v, p - q) <= radius for j, h, v, q in rows)}


def test_isolated(spark):
    rows = points(120) + [(500, "a", 300.0, 0.0), (501, "a", 312.0, 0.0), (502, "a", 330.0, 0.0), (503, "a", 330.0, 0.0), (504, "b", 0.0, 400.0)]
    got = variety.varied_subset(frame(spark, rows), "id", ["g"], ["y", "p"], 60, radius=12.0)
    assert {r["id"] for r in got.collect() if r["mandatory"]} == alone(rows, 12.0)
    assert {504} <= alone(rows, 12.0) and not {500, 501, 502, 503} & alone(rows, 12.0)


@pytest.mark.parametrize("size", [30, 77, 1000, 0.25])
@pytest.mark.parametrize("rule", ["sqrt", "equal"])
def test_size_and_membership(spark, size, rule):
    rows = points(200)
    got = [r["id"] for r in variety.varied_subset(frame(spark, rows), "id", ["g"], ["y", "p"], size, rule=rule, clusters=6).collect()]
    assert len(got) == len(set(got)) == min(200, round(size * 200) if isinstance(size, float) else size)


@pytest.mark.parametrize("radius", [None, 12.0])
def test_every_group_keeps_a_record(spark, radius):
    rows = points(300) + [(1000 + i, f"g{i // 2}", 40.0 + i % 2, 0.0) for i in range(120)]
    groups = {g for _, g, _, _ in rows}
    got = variety.varied_subset(frame(spark, rows), "id", ["g"], ["y", "p"], 90, radius=radius).collect()
    assert {r["g"] for r in got} == groups and len(got) == 90


def test_a_size_below_the_number_of_groups_is_reported(spark):
    rows = [(i, f"g{i // 2}", 40.0 + i % 2, 0.0) for i in range(120)]
    with pytest.warns(UserWarning, match="50 of them come out without a record"):
        got = variety.varied_subset(frame(spark, rows), "id", ["g"], ["y", "p"], 10, clusters=1).collect()
    assert len(got) == len({r["g"] for r in got}) == 10


def test_nulls_repeats_and_empty(spark):
    rows = points(30) + [(900, "a", None, 1.0), (901, "a", float("nan"), 1.0), (None, "a", 1.0, 1.0), (902, None, 1.0, 1.0)] + points(30)[:5]
    got = {r["id"] for r in variety.varied_subset(frame(spark, rows), "id", ["g"], ["y", "p"], 10_000, radius=5.0).collect()}
    assert got == set(range(30)) | {902}
    assert variety.varied_subset(frame(spark, []), "id", ["g"], ["y", "p"], 5, radius=5.0).collect() == []


def test_quotas_are_fair_and_redistribute(spark):
    strata = spark.createDataFrame([(1, 1), (2, 1), (3, 100), (4, 100), (5, 400)], "stratum bigint, n bigint")
    equal = {r["stratum"]: r["quota"] for r in variety.cluster_quotas(strata, 62, "equal").collect()}
    assert equal == {1: 1, 2: 1, 3: 20, 4: 20, 5: 20}
    root = {r["stratum"]: r["quota"] for r in variety.cluster_quotas(strata, 42, "sqrt").collect()}
    assert sum(root.values()) == 42 and root[5] == 20 and root[3] == root[4] == 10
    assert sum(r["quota"] for r in variety.cluster_quotas(strata, 43, "equal").collect()) == 43
    assert sum(r["quota"] for r in variety.cluster_quotas(strata, 10_000).collect()) == 602


def test_clusters_follow_the_data(spark):
    rows = [(i, "a", 50.0 * (i % 3), 0.001 * i) for i in range(300)]
    got = variety.clustered(frame(spark, rows).drop("cluster"), "id", ["y", "p"], 3).collect()
    by = {}
    for r in got:
        by.setdefault(r["y"], set()).add(r["cluster"])
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == 3


def test_p5_found_is_the_mandatory_part_of_the_subset(spark, small, monkeypatch):
    drawn = []
    real = variety.varied_subset
    monkeypatch.setattr(variety, "varied_subset", lambda *a, **k: drawn.append(real(*a, **k)) or drawn[-1])
    got = {r["frame_id"] for r in queries.p5_found(spark, small).collect()}
    assert len(drawn) == 1 and got == {r["frame_id"] for r in drawn[0].collect() if r["mandatory"]}
