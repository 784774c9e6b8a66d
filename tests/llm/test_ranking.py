import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from lumisift.llm.ranking import combine_scores, inverse_normal, with_rank


def test_inverse_normal(spark):
    ps = [1e-6, 0.001, 0.02, 0.02425, 0.1, 0.5, 0.77, 0.98, 0.9999]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", inverse_normal(F.col("p")).alias("z")).collect()
    for r in rows:
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-7)


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_against_brute_force(spark, hot_rows):
    rnd = random.Random(2)
    rows = [(i, float(rnd.randrange(6)), rnd.random() * 1e6, -0.0 if i % 3 else 0.0) for i in range(90)]
    dirty = [(200, None, 1.0, 1.0), (201, float("nan"), 1.0, 1.0), (None, 1.0, 1.0, 1.0)] + rows[:5]
    df = spark.createDataFrame(rows + dirty, "id bigint, a double, b double, c double").withColumns({"n": F.lit(1), "s": F.lit(2), "v": F.lit("x")})
    weights = {"a": 2.0, "b": 1.0, "c": 1.0}
    got = {r["id"]: r for r in with_rank(combine_scores(df, "id", weights, hot_rows), "id").collect()}
    assert set(got) == set(range(90))
    combined = {}
    for i, *values in rows:
        z = 0.0
        for (name, w), k in zip(weights.items(), range(3)):
            column = [r[k + 1] for r in rows]
            better = sum(x > values[k] for x in column)
            equal = sum(x == values[k] for x in column)
            pct = (len(rows) - better - equal / 2) / len(rows)
            assert got[i][f"{name}_better"] == better
            assert got[i][f"{name}_pct"] == pytest.approx(pct)
            z += w * NormalDist().inv_cdf(pct)
        combined[i] = z / 4
        assert got[i]["combined"] == pytest.approx(combined[i], abs=1e-6)
    for i in combined:
        assert got[i]["rank"] == 1 + sum(got[j]["combined"] > got[i]["combined"] for j in combined)


def test_empty_and_single(spark):
    schema = "id bigint, a double"
    assert combine_scores(spark.createDataFrame([], schema), "id", {"a": 1.0}).collect() == []
    one = combine_scores(spark.createDataFrame([(1, 5.0)], schema), "id", {"a": 1.0}).collect()
    assert one[0]["a_pct"] == 0.5 and math.isclose(one[0]["combined"], 0.0, abs_tol=1e-9)
