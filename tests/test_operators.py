"""Ranks, sampling, duplicates, selection, lookups and merging against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.functions import kernels
from lumisift.operators import dedup, graph, lookup, merge, prefix, ranks, reports, sampling, select, skew, vectors
from lumisift.params import DedupParams, ExtractParams, SelectionParams


def test_percentiles(spark):
    def run(f, xs):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i bigint, x double")
        return [r["p"] for r in f(df, "x", "p").orderBy("i").collect()]

    assert run(ranks.dense_percentile, [5.0, 1.0, 5.0, 9.0]) == [50.0, 0.0, 50.0, 100.0]
    assert run(ranks.dense_percentile, [7.0, 7.0]) == [100.0, 100.0]
    assert run(ranks.midrank_percentile, [1.0, 5.0, 5.0, 9.0]) == [0.0, 50.0, 50.0, 100.0]
    assert run(ranks.midrank_percentile, [3.0, None, float("nan")]) == [100.0, None, None]
    assert run(ranks.midrank_percentile, [4.0, 4.0]) == [50.0, 50.0]
    assert run(ranks.midrank_percentile, []) == []


def test_prefix_counts_and_row_numbers(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(3), float(v), rnd.randrange(1, 5)) for v in range(40)]
    got = {(r["g"], r["v"]): (r["below"], r["total"]) for r in prefix.prefix_counts(spark.createDataFrame(rows, "g int, v double, n bigint"), "g", "v", "n", 5).collect()}
    for g, v, _ in rows:
        assert got[(g, v)] == (sum(n for h, w, n in rows if h == g and w < v), sum(n for h, _, n in rows if h == g))
    xs = [(i, float(rnd.randrange(6))) for i in range(50)]
    numbers = ranks.global_row_number(spark.createDataFrame(xs, "i bigint, x double"), [-F.col("x"), F.col("i")], "rn").collect()
    assert {r["i"]: r["rn"] for r in numbers} == {i: n + 1 for n, (i, _) in enumerate(sorted(xs, key=lambda t: (-t[1], t[0])))}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_skew_join(spark, how):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)] + [(99, None)], "i bigint, k string")
    dim = spark.createDataFrame([("hot", 40, "H"), ("k0", 1, "A"), ("zz", 1, "Z")], "k string, n bigint, v string")
    got = skew.skew_join(big, dim, ["k"], "n", 10, F.col("i"), how)
    want = big.join(dim.drop("n"), "k", how)
    assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))
    assert skew.hot_threshold(10**12) == 10**9 and skew.hot_threshold(0) == skew.HOT_ROWS


@pytest.fixture
def plain_joins(spark):
    """Sixteen partitions that nothing coalesces, and no joins by broadcast."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("hot", [-7, None])
def test_hot_keys_are_spread(spark, plain_joins, how, hot):
    """Half of the rows on one key, or on null: the fullest task holds less than twice the mean."""
    big = spark.range(100_000).select(F.col("id").alias("i"), F.when(F.col("id") % 2 == 0, F.lit(hot).cast("bigint")).otherwise(F.col("id")).alias("k"))
    dim = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("v"))
    for joined in (skew.skew_join(big, dim, ["k"], "n", 10_000, F.col("i"), how), skew.spread_join(big, dim.drop("n"), ["k"], F.col("i"), 100_000, how, least=10_000)):
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == (100_000 if hot or how == "left" else 50_000)
        assert max(sizes) < 2 * sum(sizes) / 16
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert all("__salt" in line for line in plan.splitlines() if "SortMergeJoin" in line)


def test_candidates_of_a_growing_scene(spark):
    """One scene without times whose frames all look one way: the unrelated frames met by a frame grow far slower than the scene."""
    met = {}
    for n in (500, 16_000):
        rows = spark.range(n).select(F.col("id").alias("rep"), F.lit("a").alias("scene"), F.lit("S").alias("shot"), F.lit(None).cast("int").alias("t"), (F.col("id") % 7).cast("double").alias("yaw"), F.lit(0.0).alias("pitch"), F.xxhash64("id").alias("gh"), F.lit(None).cast("bigint").alias("fh"))
        one, other = dedup.candidates(rows, DedupParams())
        met[n] = one.alias("a").join(other.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.rep") < F.col("b.rep"))).count() / n
        h = np.array([r["gh"] for r in rows.select("gh").collect()]).view(np.uint64)
        assert dedup.near_pairs(rows).count() == sum(int((np.bitwise_count(h[i + 1 :] ^ x) <= 10).sum()) for i, x in enumerate(h))
    assert met[16_000] < met[500] * 4, met


def test_best_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 1.0, 1), ("a", None, 0), ("b", None, 9)], "g string, s double, seq bigint")
    assert {(r["g"], r["seq"]) for r in ranks.best_per_group(df, ["g"], "s", "seq").collect()} == {("a", 1), ("b", 9)}
    assert ranks.first_n(df, "seq", 0).count() == 4 and [r["seq"] for r in ranks.first_n(df, "seq", 2).collect()] == [0, 1]


def test_sampling(spark):
    def times(d, **kw):
        rows = sampling.frame_plan(spark.createDataFrame([("v.mp4", d)], "video string, duration_sec double"), p=ExtractParams(**kw)).orderBy("idx").collect()
        return [r["t"] for r in rows], [r["frame"] for r in rows]

    t, names = times(10.0)
    assert (t[0], t[-1], len(t), names[0]) == (0.5, 9.5, 50, "v_001.png") and t[1] - t[0] == pytest.approx(9 / 49)
    short = times(0.8)[0]
    assert (short[0], short[-1]) == pytest.approx((0.04, 0.76))
    assert times(10.0, num_frames=1)[0] == [5.0] and times(0.0)[0] == [] and times(None)[0] == []


def test_components(spark):
    edges = [(1, 3), (2, 3), (10, 11), (11, 12), (12, 13), (13, 14), (5, 5), (None, 1)]
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 3, 5, 10, 11, 12, 13, 14)], "node bigint")
    got = {r["node"]: r["component"] for r in graph.component_labels(nodes, spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 10: 10, 11: 10, 12: 10, 13: 10, 14: 10}
    ids = spark.createDataFrame([(i,) for i in range(40)], "n bigint")
    chain = spark.createDataFrame([(i, i + 1) for i in range(39)], "a bigint, b bigint")
    assert {r["c"] for r in graph.propagate_labels(ids, chain).collect()} == {0}
    long = graph.component_labels(ids.withColumnRenamed("n", "node"), chain.repartition(7).withColumn("k", F.lit(1)), "node", "a", "b")
    assert {r["component"] for r in long.collect()} == {0}


def near(a, b, p):
    gap = math.hypot(a[4] - b[4], a[5] - b[5]) if None not in (a[4], b[4], a[5], b[5]) else 999
    bits = lambda x, y: 99 if x is None or y is None else bin((x ^ y) & (2**64 - 1)).count("1")
    g, f = bits(a[6], b[6]), bits(a[7], b[7])
    return a[1] == b[1] and a[2] == b[2] and ((gap <= p.angle and abs(a[3] - b[3]) <= p.time_window and min(g, f) <= p.near_hash) or (gap <= p.strict_angle and min(g, f) <= p.phash))


@pytest.mark.parametrize("level, p", [(None, DedupParams()), (1, DedupParams()), (2, DedupParams()), (3, DedupParams()), (None, DedupParams(time_window=2, phash=2, strict_angle=1.0)), (1, DedupParams(time_window=3, phash=1, strict_angle=0.0))])
def test_duplicates_against_brute_force(spark, monkeypatch, level, p):
    """Every level of agreeing pieces finds the same pairs; None lets the cells' sizes decide."""
    if level is not None:
        monkeypatch.setattr(dedup, "_level", lambda n, distance: F.lit(level))
    rnd = random.Random(2)
    seeds = [rnd.getrandbits(64) - 2**63 for _ in range(6)]

    def noisy(h):
        for _ in range(rnd.randrange(14)):
            h ^= 1 << rnd.randrange(63)
        return h

    rows = [(i, rnd.choice("ab"), rnd.choice(["S", None]), rnd.randrange(40), rnd.uniform(-30, 30), rnd.uniform(-10, 10), noisy(rnd.choice(seeds)), rnd.choice([None, noisy(seeds[0])])) for i in range(90)]
    rows += [(100 + i, *rows[i][1:]) for i in range(5)] + [(200, "a", "S", 1, None, 2.0, seeds[0], None), (201, "a", "S", 1, None, 2.0, seeds[0], None), (202, "a", "S", 1, 1.0, 1.0, None, None)]
    df = spark.createDataFrame(rows, "seq bigint, scene string, shot string, t int, yaw double, pitch double, gh bigint, fh bigint")
    got = {r["seq"]: (r["component"], r["links"]) for r in dedup.duplicate_links(df, p).collect()}
    real = [r for r in rows if r[6] is not None or r[7] is not None]
    assert set(got) == {r[0] for r in real}
    for a in real:
        assert got[a[0]][1] == sum(near(a, b, p) for b in real if b[0] != a[0]), a
    for a in real:
        for b in real:
            if a[0] < b[0] and near(a, b, p):
                assert got[a[0]][0] == got[b[0]][0]
    with pytest.raises(ValueError):
        dedup.near_pairs(df, DedupParams(phash=32))


def greedy(rows, p):
    """The selection as one loop."""
    order = sorted(rows, key=lambda r: (-(math.floor(r[4] * 100 + 0.5) / 100), r[0]))
    cap = lambda s: p.max_reference_burst if "reference" in s or "identity" in s else p.max_scene_burst
    scenes, shots, poses, picked = {}, {}, {}, {}

    def take(r, phase):
        picked[r[0]] = phase
        for d, k in ((scenes, r[1]), (shots, r[2]), (poses, r[3])):
            d[k] = d.get(k, 0) + 1

    for r in order:
        if "PROFILE" in r[3]:
            take(r, 1)
    for r in order:
        if r[0] in picked or scenes.get(r[1], 0) >= cap(r[1]):
            continue
        if shots.get(r[2], 0) < p.shot_min.get(r[2], 0) or poses.get(r[3], 0) < p.pose_min.get(r[3], 0):
            take(r, 2)
            if len(picked) >= p.target:
                break
    for r in order:
        if len(picked) >= p.target:
            break
        if r[0] in picked or scenes.get(r[1], 0) >= cap(r[1]):
            continue
        if shots.get(r[2], 0) < p.shot_max.get(r[2], 999) and poses.get(r[3], 0) < p.pose_max.get(r[3], 999):
            take(r, 3)
    ranked = sorted(picked, key=lambda s: (-next(math.floor(r[4] * 100 + 0.5) / 100 for r in rows if r[0] == s), picked[s], s))
    return picked, {s: i + 1 for i, s in enumerate(ranked)}


@pytest.mark.parametrize("profiles, scenes, target", [(0.1, 30, 65), (0.5, 10, 65), (0.05, 3, 20), (0.0, 60, 40)])
def test_selection_against_brute_force(spark, profiles, scenes, target):
    rnd = random.Random(int(profiles * 100) + scenes)
    pose_names = ["FRONT", "LEFT_3Q", "RIGHT_3Q", "LOOKING_DOWN", "LOOKING_UP", "EXTREME_POSE"]
    rows = [(i, rnd.choice(["reference_x"] + [f"s{k}" for k in range(scenes)]), rnd.choice(["CLOSE_UP", "UPPER_BODY", "FULL_BODY"]), "LEFT_PROFILE" if rnd.random() < profiles else rnd.choice(pose_names), rnd.randrange(3000) / 100) for i in range(400)]
    p = SelectionParams(target=target)
    got = select.select_by_quota(spark.createDataFrame(rows, "seq bigint, scene string, shot string, pose string, score double"), p).collect()
    picked, order = greedy(rows, p)
    phase = {"selected_profile_priority": 1, "selected_quota_minimum": 2, "selected_score_fill": 3}
    assert {r["seq"]: phase[r["quota_status"]] for r in got if r["candidate_selected"]} == picked
    assert {r["seq"]: r["candidate_rank"] for r in got if r["candidate_selected"]} == order
    assert len(got) == 400


def test_selection_of_nothing(spark):
    assert select.select_by_quota(spark.createDataFrame([], "seq bigint, scene string, shot string, pose string, score double")).collect() == []


def test_substring_join(spark):
    names = [(1, "video_abc_001.png"), (2, "xyz.png"), (3, None), (4, "short"), (5, "")]
    keys = [("abc_001", 2), ("abc", 3), ("video_abc_001", 1), ("or", 9), ("", 0), (None, 0), ("or", 4)]
    got = lookup.substring_join(spark.createDataFrame(names, "i int, name string"), "name", spark.createDataFrame(keys, "k string, seq int"), "k", "seq").collect()
    assert {r["i"]: r["k"] for r in got} == {1: "video_abc_001", 2: None, 3: None, 4: "or", 5: None}
    none = lookup.substring_join(spark.createDataFrame(names, "i int, name string"), "name", spark.createDataFrame([], "k string, seq int"), "k", "seq")
    assert none.count() == 5


def test_lookup_and_upsert(spark):
    left = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, k string")
    right = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), (None, 3, "x"), ("", 4, "y")], "k string, seq int, v string")
    assert {r["i"]: r["v"] for r in lookup.lookup_join(left, right, "k", "seq", {"v": "none"}).collect()} == {1: "new", 2: "none", 3: "none"}
    new = spark.createDataFrame([("b", 1, "n")], "k string, seq int, v string")
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "o"), ("a", 3, "y"), ("C", 4, "z")], "k string, seq int, v string")
    got = merge.upsert(new, old, "k", "seq").orderBy("__part", "__order").collect()
    assert [(r["k"], r["v"]) for r in got] == [("b", "n"), ("a", "y"), ("C", "z")]
    assert merge.skip_existing(old, new, "k").count() == 3 and merge.skip_existing(old, new, "k", True).count() == 4


def test_similarities(spark):
    rnd = random.Random(3)
    rows = [(i, i % 2, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(30)] + [(99, 0, [0.0] * 8)]
    got = {r["id"]: r for r in vectors.similarities(spark.createDataFrame(rows, "id int, g int, v array<double>"), "g", "id", "v", 5).collect()}
    length = lambda v: math.sqrt(sum(x * x for x in v))
    for i, g, v in rows:
        bank = [w for _, h, w in rows if h == g][:5]
        centre = [sum(x) / 5 for x in zip(*bank)]
        cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / max(length(a) * length(b), 1e-12)
        assert got[i]["similarity_mean"] == pytest.approx(cos(v, centre), abs=1e-9)
        assert got[i]["similarity_max"] == pytest.approx(max(cos(v, b) for b in bank), abs=1e-9)


def test_reports(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, False), (None, True), (float("nan"), None)], "x double, f boolean")
    assert reports.summary_text(df, "x").first()[0] == "1.00 / 1.50 / 2.00"
    assert reports.summary_text(df.filter("x is null"), "x").first()[0] == "n/a"
    assert [r["n"] for r in reports.flag_funnel(df, {"f": F.col("f"), "x": F.col("x") > 1.5}).orderBy("stage_no").collect()] == [4, 2, 0]
    assert [(r["n"], r["share_e4"]) for r in reports.funnel([("a", df), ("b", df.filter("f"))]).orderBy("stage_no").collect()] == [(4, 10000), (2, 5000)]


def test_kernels(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    img = rng.integers(0, 256, (40, 50)).astype(float)
    m = kernels.technical_metrics(img)
    assert m["brightness_mean"] == round(float(img.mean()), 3) and m["shadow_pixel_ratio"] == round(float((img < 40).mean()), 3)
    assert kernels.technical_metrics(np.full((5, 5), 9.0))["laplacian_score"] == 0.0
    ramp = np.tile(np.arange(20.0), (10, 1))
    assert kernels.gradients(ramp)[0][5, 5] == 8.0 and kernels.gradients(ramp)[1][5, 5] == 0.0
    assert kernels.perceptual_hash(img) == kernels.perceptual_hash(img * 0.5) and -(2**63) <= kernels.perceptual_hash(img) < 2**63
    assert kernels.pixel_box(-0.1, 0.1, 0.5, 0.5, 100, 100) == (0, 10, 40, 50)
    assert kernels.scaled_box((10, 10, 20, 20), 100, 100, margin=0.2) == (6, 6, 34, 34) and kernels.scaled_box((10, 10, 20, 20), 100, 100, core=0.8) == (12, 12, 28, 28)
    assert kernels.pixel_fidelity(img, img) == 1.0 and kernels.patch_sharpness(img[:2]) == 0.0
    same = kernels.blend(img, img[5:25, 5:35], 5, 5)
    assert np.allclose(same, img)
    assert kernels.polygon_gradient(ramp, [(2, 2), (15, 2), (15, 8), (2, 8)]) == pytest.approx(8.0)
    got = spark.createDataFrame([([1.0] * 8,), ([1.0] * 7,), (None,)], "p array<double>").select(kernels.technical_metrics_udf(F.col("p"), 4).alias("m")).collect()
    assert got[0]["m"]["brightness_mean"] == 1.0 and got[1]["m"]["error"] and got[2]["m"]["error"]
    with pytest.raises(kernels.ModelRequired):
        kernels.face_embedding(img)


def test_face_and_resize_kernels():
    import numpy as np

    rnd = np.random.default_rng(3)
    gray = rnd.integers(0, 255, (120, 160)).astype(np.uint8)
    mesh = [(0.5, 0.5)] * 468
    for i, at in {61: (0.4, 0.8), 291: (0.6, 0.8), 33: (0.2, 0.3), 133: (0.4, 0.3), 362: (0.6, 0.3), 263: (0.8, 0.3), 50: (0.3, 0.6), 280: (0.7, 0.6)}.items():
        mesh[i] = at
    eyes, mouth = kernels.anatomical_sharpness(gray, mesh)
    assert eyes > 0 and mouth > 0 and kernels.anatomical_sharpness(gray, None) == (0.0, 0.0)
    assert kernels.anatomical_sharpness(gray, mesh, eye_valid=False) == (0.0, mouth)
    flat = gray.copy()
    flat[:60, :80] = 9  # one eye without any gradient
    assert kernels.anatomical_sharpness(flat, mesh)[0] == 0.0
    texture, plasticity = kernels.cheek_texture(gray, mesh, (0, 0, 100, 100), 2.0)
    assert texture > 0 and plasticity == 2.0 / texture and kernels.cheek_texture(gray, None, (0, 0, 9, 9), 2.0) == (0.0, 0.0)
    assert kernels.cheek_texture(np.full((120, 160), 50), mesh, (0, 0, 100, 100), 2.0) == (0.0, 400.0)
    assert kernels.face_box(mesh, 160, 120) == (32, 36, 96, 60) and kernels.face_box([], 160, 120) is None
    assert kernels.aligned_picture(gray[:, :, None].repeat(3, 2)).shape == (128, 160, 3)
    assert kernels.aligned_picture(gray[:112]) is not None and kernels.aligned_picture(gray[:112]).shape == (112, 160)
    assert (kernels.lanczos(np.full((50, 37), 77, np.uint8), 48, 32) == 77).all() and np.array_equal(kernels.lanczos(gray, 120, 160), gray)
    ramp = np.tile(np.arange(100.0), (10, 1))
    assert np.allclose(kernels.lanczos(ramp, 10, 200)[:, 20:180], ((np.arange(200) + 0.5) / 2 - 0.5)[20:180], atol=0.1)
    assert kernels.comparison_strip(gray, gray[:30, :40]).shape == (256, 512)
