import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumisift.llm import quotas

cells = st.lists(st.tuples(st.floats(0, 1), st.integers(0, 20), st.integers(0, 60)), min_size=1, max_size=8)


@settings(max_examples=200, deadline=None)
@given(cells, st.integers(0, 200))
def test_allocation(rows, size):
    share, floor, have = (np.array(x, dtype=float) for x in zip(*rows))
    q = quotas.allocate(share, floor, have, size)
    least = np.minimum(floor, have)
    assert (q >= least).all() and (q <= have).all()
    assert q.sum() == max(least.sum(), min(size, have.sum()))


def test_largest_remainder():
    assert quotas.allocate(np.array([0.5, 0.3, 0.2]), np.zeros(3), np.full(3, 100.0), 7).tolist() == [4, 2, 1]
    assert quotas.allocate(np.array([0.5, 0.3, 0.2]), np.array([0, 0, 3.0]), np.array([100, 1.0, 100]), 10).tolist() == [6, 1, 3]


def test_report_and_sample(spark):
    members = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(90)] + [(500, None)], "id bigint, category string").withColumns({"stratum": F.lit(1), "u": F.lit(2), "kept": F.lit(3)})
    targets = spark.createDataFrame([(1, "a", 0.5, 2, 40), (1, "b", 0.45, 2, 40), (1, "c", 0.05, 3, 40), (2, "a", 0.07, 0, 100), (2, "b", 0.93, None, 100)], "request_id int, category string, target_share double, min_count int, sample_size int")
    report = quotas.quota_report(members, targets)
    rows = {(r["request_id"], r["category"]): r for r in report.collect()}
    assert {k for k, r in rows.items() if r["unmet"]} == {(1, "c"), (2, "b")}
    assert rows[(2, "a")]["needed"] == 7.0 and rows[(1, "c")]["available"] == 0
    drawn = quotas.draw_sample(members.select("id", "category"), report, "id", hot_rows=10).collect()
    assert len({(r["request_id"], r["id"]) for r in drawn}) == len(drawn)
    for k, r in rows.items():
        assert sum((d["request_id"], d["category"]) == k for d in drawn) == r["quota"]
    again = quotas.draw_sample(members.select("id", "category"), report, "id").collect()
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, again))


def test_empty(spark):
    members = spark.createDataFrame([], "id bigint, category string")
    targets = spark.createDataFrame([(1, "a", 1.0, 2, 5)], "request_id int, category string, target_share double, min_count int, sample_size int")
    report = quotas.quota_report(members, targets)
    assert [(r["quota"], r["unmet"]) for r in report.collect()] == [(0, True)]
    assert quotas.draw_sample(members, report, "id").collect() == []
    assert quotas.quota_report(members, targets.limit(0)).collect() == []


def test_cells(spark):
    rows = [("CLOSE_UP", "FRONT", "x"), (" ", "FRONT", "Close-Up Front"), (None, None, None), ("close/up", "left 3q", None)]
    df = spark.createDataFrame(rows, "s string, p string, c string")
    assert [r[0] for r in df.select(quotas.cell_of(F.col("s"), F.col("p"), F.col("c"))).collect()] == ["closeupfront", "closeupfront", "", "closeupleft3q"]
