import random

from pyspark.sql import functions as F

from lumisift.llm.capping import cap_contributors, share_cap


def brute(rows, cap):
    best = {}
    for who, score, tie in rows:
        if score is None or score != score or tie is None:
            continue
        key = (who or "", tie)
        best[key] = max(best.get(key, score), score)
    kept = set()
    groups = {}
    for (who, tie), score in best.items():
        groups.setdefault(who, []).append((-score, tie))
    for who, items in groups.items():
        kept |= {(who, t) for _, t in sorted(items)[: cap(who)]}
    return set(best), kept


def table(spark, rows):
    df = spark.createDataFrame(rows, "who string, score double, tie bigint")
    return df.withColumns({c: F.lit(1) for c in ("kept", "quota", "__bin", "__rows")})


def result(df):
    rows = df.collect()
    return {(r["who"], r["tie"]) for r in rows}, {(r["who"], r["tie"]) for r in rows if r["kept"]}


def test_against_brute_force_with_ties_nulls_and_a_hot_contributor(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b", None, "ref"] + ["hot"] * 4), float(rnd.randrange(5)), i) for i in range(400)]
    rows += [("a", None, 900), ("a", float("nan"), 901), ("b", 3.0, None)] + rows[:30]
    cap = lambda who: 15 if who == "ref" else 8
    want = brute(rows, cap)
    limit = F.when(F.col("who") == "ref", 15).otherwise(8)
    for hot_rows in (None, 20):
        got = result(cap_contributors(table(spark, rows), "who", "score", "tie", limit, bins=4, hot_rows=hot_rows))
        assert got == want


def test_null_of_a_numeric_contributor_is_capped(spark):
    rows = [(None if i % 3 == 0 else i % 5, float(i % 7), i) for i in range(200)]
    df = spark.createDataFrame(rows, "who bigint, score double, tie bigint")
    want = {}
    for who, score, tie in rows:
        want.setdefault(who, []).append((-score, tie))
    limit = F.when(F.col("who") == 1, 6).otherwise(4)
    best = {(who, t) for who, x in want.items() for _, t in sorted(x)[: 6 if who == 1 else 4]}
    for hot_rows in (None, 20):
        every, kept = result(cap_contributors(df, "who", "score", "tie", limit, bins=4, hot_rows=hot_rows))
        assert kept == best and every == {(who, t) for who, _, t in rows}
    assert cap_contributors(df, "who", "score", "tie", max_share=0.2).dtypes[0] == ("who", "bigint")


def test_all_scores_equal_and_cap_zero(spark):
    rows = [("x", 7.0, i) for i in range(50)]
    assert result(cap_contributors(table(spark, rows), "who", "score", "tie", 8))[1] == {("x", i) for i in range(8)}
    assert result(cap_contributors(table(spark, rows), "who", "score", "tie", 0))[1] == set()
    assert len(result(cap_contributors(table(spark, rows), "who", "score", "tie", 50))[1]) == 50


def test_empty(spark):
    assert cap_contributors(table(spark, []), "who", "score", "tie", 8).collect() == []
    assert cap_contributors(table(spark, []), "who", "score", "tie", max_share=0.5).collect() == []


def test_share(spark):
    def best_cap(sizes, share):
        ok = [c for c in range(1, max(sizes) + 1) if c <= share * sum(min(s, c) for s in sizes) + 1e-9]
        return max(ok) if ok else min(sizes)

    for sizes in ([100, 3, 4, 5], [10, 10, 10], [50, 40, 30, 20, 10, 1, 1], [7]):
        df = spark.createDataFrame([(s,) for s in sizes], "n bigint")
        for share in (0.1, 0.25, 0.4, 0.5, 1.0):
            assert share_cap(df, "n", share) == best_cap(sizes, share), (sizes, share)
