"""What the found rows rest on: heads, frames, shortfalls and mixes from the methods; hot keys in parts; cuts per language."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.llm import capping, components, mixing, quotas, ranking, reading, survivors, variety


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_components_with_a_giant_star_and_chain(spark, hot_rows):
    edges = [(0, i) for i in range(1, 150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(149, 1000), (5000, 5001), (7, 7), (None, 3)]
    got = {r["node"]: r["group_id"] for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b", hot_rows).collect()}
    assert got == {**{i: 0 for i in range(150)}, **{1000 + i: 0 for i in range(61)}, 5000: 5000, 5001: 5000}


def test_cells_of_the_grid_are_united_apart(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "src bigint, dst bigint")
    cells = components._grid(edges, 200)
    assert cells.select("cell").distinct().count() == components.SIDE**2
    links = cells.mapInArrow(components.unite_cells, "v bigint, r bigint").collect()
    pairs = {(r["v"], r["r"]) for r in links}
    assert len({v for v, _ in pairs}) > 100 and len(pairs) < 200 + 1  # no cell sees the whole chain
    assert len({r for _, r in pairs}) > 10


def test_head_of_the_ranking(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(20) / 2.0, rnd.random(), rnd.choice([1.0, 2.0])) for i in range(200)] + [(500, 99.0, 9.0, 2.0), (501, None, 9.0, 2.0)]
    got = {r["id"]: r for r in ranking.combine_scores(spark.createDataFrame(rows, "id bigint, a double, b double, c double"), "id", {"a": 1.0, "b": 2.0, "c": 1.0}, head=0.2).collect()}
    real = [r for r in rows if r[1] is not None]
    want = {r[0] for r in real if all(sum(o[k] > r[k] for o in real) < 0.2 * len(real) for k in (1, 2, 3))}
    assert {i for i, r in got.items() if r["head_all"]} == want and 500 in want
    assert want <= {i for i, r in got.items() if r["head_combined"]} < set(got)


def test_frame_is_a_bundle_of_the_search():
    options = {"frame": [(40.0, "", "", 9), (40.0, "", "", 4), (12.0, "", "", 1)], "shot": [(5.0, "closeup", "", 77)]}
    best = survivors.best_bundles(options)
    assert best["frame"][3] == 4 and best["shot"][3] == 77


def test_tied_scores_with_half_of_the_rows_on_one_contributor(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("who"), F.lit(3.0).alias("score"), F.col("id").alias("tie"))
    flagged = capping.cap_contributors(rows, "who", "score", "tie", 700, hot_rows=100)
    kept = flagged.filter("kept").groupBy("who").agg(F.count(F.lit(1)).alias("n"), F.max("tie").alias("last")).collect()
    assert {r["who"]: (r["n"], r["last"]) for r in kept}["hot"] == (700, 1398)
    assert sum(r["n"] for r in kept) == 700 + 2000


def test_only_a_lack_of_records_is_a_shortfall(spark):
    members = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in range(100)], "id bigint, category string")
    targets = spark.createDataFrame([(1, "a", 0.1, 0, 100), (1, "b", 0.3, 0, 100), (1, "c", 0.6, 0, 100), (2, "a", 0.5, 5, 10), (2, "b", 0.5, 9, 10)], "request_id int, category string, target_share double, min_count int, sample_size int")
    got = {(r["request_id"], r["category"]): (r["quota"], r["shortfall"], r["unmet"]) for r in quotas.quota_report(members, targets).collect()}
    assert got[1, "a"] == (5, 5.0, True) and got[1, "c"] == (0, 60.0, True) and not got[1, "b"][2]
    assert not got[2, "a"][2] and not got[2, "b"][2]  # floors of 14 for 10 slots, but records enough


def test_mix_of_a_given_entropy(spark):
    sizes = spark.createDataFrame([(i, "abc"[min(i, 2)], n) for i, n in enumerate([1000, 100, 10])], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([(1, s, None, 5, 100, math.log(3) * 0.9) for s in "abc"], "mix_id int, source string, target_weight double, max_repeats int, total_tokens bigint, entropy_target double")
    plan = mixing.mix_plan(sizes, targets).collect()
    weights = np.array([r["target_weight"] for r in plan])
    assert mixing.entropy(weights) == pytest.approx(math.log(3) * 0.9, abs=1e-6) and 0 < plan[0]["exponent"] < 1
    report = mixing.mix_report(mixing.mix_plan(sizes, targets), mixing.realise(sizes, mixing.mix_plan(sizes, targets))).collect()
    assert {r["source"] for r in report if r["unmet"]} <= {r["source"] for r in plan if r["short"]}


def test_used_up_source_is_unmet(spark):
    sizes = spark.createDataFrame([(1, "a", 10), (2, "b", 1000), (3, "b", 0)], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([(1, "A!", 0.5, 2, 100), (1, "b", 0.5, 2, 100), (2, "gone", 1.0, 2, 50)], "mix_id int, source string, target_weight double, max_repeats int, total_tokens bigint")
    plan = mixing.mix_plan(sizes, targets)
    got = {(r["mix_id"], r["source"]): (r["reached_tokens"], r["unmet"], r["short"]) for r in mixing.mix_report(plan, mixing.realise(sizes, plan)).collect()}
    assert got[1, "A!"] == (20, True, True) and got[2, "gone"] == (0, True, True) and not got[1, "b"][1]


def test_no_language_takes_the_room_of_another(spark):
    docs = [(i, f"Common words here come often {'abcdefghij'[i % 10] * 3}{'klmnopqrst'[i // 10] * 3} today.", "en") for i in range(100)] + [(200, "Wenige deutsche Worte stehen hier.", "de")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    v = reading.corpus_vocabulary(d, words=30)
    assert {"wenige", "deutsche", "worte"} <= set(v.index) and "common" in v.index and "aaakkk" not in v.index
    assert v.languages == ["en", "de"] and len(reading.corpus_vocabulary(d).index) > 100


def test_lone_records_come_from_their_own_strata(spark):
    rows = [(i, "g", float(i % 5), 0.0) for i in range(60)] + [(100, "g", 90.0, 0.0), (101, "h", 5.0, 5.0)]
    got = variety.varied_subset(spark.createDataFrame(rows, "id bigint, g string, y double, p double"), "id", ["g"], ["y", "p"], 10, radius=12.0).collect()
    assert {r["id"] for r in got if r["mandatory"]} == {100, 101} and len(got) == 10
