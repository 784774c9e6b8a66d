import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.llm import components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    groups = {}
    for x in parent:
        groups.setdefault(find(x), []).append(x)
    return {x: min(g) for g in groups.values() for x in g}


def run(spark, edges):
    df = spark.createDataFrame(edges, "src bigint, dst bigint").withColumns({"v": F.lit(1), "node": F.lit("x"), "root": F.lit(0)})
    rows = components.connected_components(df, "src", "dst").collect()
    got = {r["node"]: r["group_id"] for r in rows}
    assert len(got) == len(rows)
    return got


def test_local_union_find():
    rnd = np.random.default_rng(1)
    src, dst = rnd.integers(0, 400, 300), rnd.integers(0, 400, 300)
    ids, rep = components.union_find(src, dst)
    want = brute([(int(a), int(b)) for a, b in zip(src, dst)])
    by = {}
    for i, r in zip(ids.tolist(), rep.tolist()):
        by.setdefault(r, set()).add(want.get(i, i))
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({want.get(i, i) for i in ids.tolist()})


@pytest.mark.parametrize("cell_edges", [500_000, 20])
def test_random_chain_and_star(spark, monkeypatch, cell_edges):
    monkeypatch.setattr(components, "CELL_EDGES", cell_edges)
    rnd = random.Random(4)
    chain = [(1000 + i, 1001 + i) for i in range(150)]
    star = [(5000, 5001 + i) for i in range(200)]
    noise = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)]
    edges = chain + star + noise + noise[:20] + [(7, 7), (None, 3), (4, None), (9999, 9999)]
    rnd.shuffle(edges)
    assert run(spark, edges) == brute(edges)


def test_empty(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, 1), (None, None)]) == {}


def test_links_of_reports(spark):
    rows = [
        (1, "a/x_1.png", "a\\X_2.PNG ", 3, 5.0), (2, "a/x_2.png", "a/x_2.png", 0, 0.0), (3, "a/x_3.png", "./a/x_1.png", 15, 1.0), (4, "a/x_4.png", "a/x_1.png", 14, 12.0),
        (5, "a/x_5.png", "a/x_1.png", None, 1.0), (6, "a/x_6.png", "a/x_1.png", 1, float("nan")), (7, "a/x_7.png", "nobody.png", 1, 1.0), (8, "a/x_8.png", None, 1, 1.0), (None, "a/x_9.png", "a/x_1.png", 1, 1.0),
    ]
    df = spark.createDataFrame(rows, "frame_id bigint, filename string, group_best string, phash_distance_to_group_best int, angle_distance_to_group_best double").withColumn("name", F.lit("x"))
    assert {(r["src"], r["dst"]) for r in components.report_links(df).collect()} == {(1, 2), (4, 1)}
