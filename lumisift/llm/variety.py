"""Problem 5: choosing a varied subset by mini-batch k-means and quotas per cluster."""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spelling import canonical
from ..operators.skew import hot_threshold, skew_join
from ..session import cut_lineage
from .capping import top_by_cutoff
from .reports import number, scene_key

#: Clusters, rows of a mini-batch and batches of the k-means; at most BATCH x BATCHES rows are ever read by the driver.
CLUSTERS = 32
BATCH = 2048
BATCHES = 20


def _seeds(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centres spread out by squared distance (k-means++)."""
    centres = [points[rng.integers(len(points))]]
    far = ((points - centres[0]) ** 2).sum(1)
    for _ in range(1, k):
        if far.sum() <= 0:
            break
        centres.append(points[rng.choice(len(points), p=far / far.sum())])
        far = np.minimum(far, ((points - centres[-1]) ** 2).sum(1))
    return np.array(centres)


def mini_batch_kmeans(rows: DataFrame, features: list[str], key: str, clusters: int = CLUSTERS, batch: int = BATCH, batches: int = BATCHES, seed: int = 7) -> np.ndarray:
    """Centres of ``features`` fitted on ``batches`` random mini-batches of at most ``batch`` rows.

    The batches are the rows whose hash falls below a bound set from the row count, so that ``batch * batches`` rows (a fixed number) are
    expected at the driver at any size of the table; every row is assigned later. Each centre moves towards its share of a
    batch with a step of one over the rows it has seen. No rows give no centres.
    """
    total = rows.count()
    share = min(1.0, batch * batches / max(total, 1))
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 40)) / float(1 << 40)
    picked = rows.filter(u < share).orderBy(u).limit(batch * batches).select(*[F.col(c).cast("double") for c in features]).collect()
    if not picked:
        return np.empty((0, len(features)))
    points = np.array([tuple(r) for r in picked])
    rng = np.random.default_rng(seed)
    centres = _seeds(points[:batch], clusters, rng)
    seen = np.zeros(len(centres))
    for start in range(0, len(points), batch):
        part = points[start : start + batch]
        near = ((part[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        for c in np.unique(near):
            own = part[near == c]
            seen[c] += len(own)
            centres[c] += (own.mean(0) - centres[c]) * len(own) / seen[c]
    return centres


def nearest(features: list[str], centres: np.ndarray) -> Column:
    """Number of the nearest centre (the first of equals), in the JVM; 0 without centres."""
    if not len(centres):
        return F.lit(0)
    far = [F.struct(sum(((F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(features, centre)), F.lit(0.0)).alias("d"), F.lit(i).alias("i")) for i, centre in enumerate(centres)]
    return F.array_min(F.array(*far)).getField("i")


def isolated(rows: DataFrame, key: str, group: list[str], features: list[str], radius: float) -> DataFrame:
    """``key`` of the records with no other record of their group within ``radius`` (inclusive).

    Space is cut into cells whose diagonal is the radius: two records in one cell prove
    each other not isolated, so only those alone in theirs are candidates, at most one per group and cell, counted on the map side. A
    candidate is then compared with what other cells hold within reach; a cell full of records is read once per candidate nearby and
    never paired with itself. Groups and cells are named by hashes (two of a group), so that short rows are shuffled. Two features or more; cells in reach grow with their number.
    """
    side = radius / math.sqrt(len(features))
    reach = math.ceil(math.sqrt(len(features)))
    cells = [f"__c{i}" for i in range(len(features))]
    xs = [f"__x{i}" for i in range(len(features))]
    total = rows.count()
    who = ("__g", "__h")
    here = F.xxhash64("__g", *cells)
    named = rows.select(key, F.xxhash64(F.lit(1), *group).alias("__g"), F.hash(F.lit(2), *group).alias("__h"), *[F.col(f).alias(x) for f, x in zip(features, xs)])
    placed = named.withColumns({c: F.floor(F.col(x) / side).cast("bigint") for x, c in zip(xs, cells)}).withColumn("__cell", here)
    own = cut_lineage(placed.groupBy("__cell", *who, *cells).agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__cand"), *[F.min(x).alias(x) for x in xs]))
    lone = own.filter("__n = 1")
    steps = F.array(*[F.lit(x) for x in range(-reach, reach + 1)])
    around = lone.select("__cand", *who, *xs, *cells)
    for c in cells:
        around = around.withColumn("__step", F.explode(steps)).withColumn(c, F.col(c) + F.col("__step")).drop("__step")
    # Only cells that the circle of the radius reaches: the distance to the nearest point of the cell decides.
    short = [F.greatest(F.col(c) * side - F.col(x), F.col(x) - (F.col(c) + 1) * side, F.lit(0.0)) for x, c in zip(xs, cells)]
    around = around.filter(sum((x * x for x in short), F.lit(0.0)) <= radius * radius + 1e-6).withColumn("__cell", here)
    # Candidates by cell as one row, so that each record meets one partner row even where a cell holds a third of all records. A cell lies in reach of a bounded number of others.
    near = around.groupBy("__cell").agg(F.collect_list(F.struct("__cand", *who, *xs)).alias("__near"))
    near = near.join(own.groupBy("__cell").agg(F.sum("__n").alias("__n")), "__cell")
    met = skew_join(placed.select(key, "__cell", *who, *xs), near, ["__cell"], "__n", hot_threshold(total), F.col(key), "inner", total)
    met = met.select(key, *who, *xs, F.explode("__near").alias("__o"))
    gap = sum(((F.col(f"__o.{x}") - F.col(x)) * (F.col(f"__o.{x}") - F.col(x)) for x in xs), F.lit(0.0))
    same = (F.col("__o.__g") == F.col("__g")) & (F.col("__o.__h") == F.col("__h")) & (F.col("__o.__cand") != F.col(key))
    met = met.filter(same & (gap <= radius * radius + 1e-9)).select(F.col("__o.__cand").alias(key)).distinct()
    return lone.select(F.col("__cand").alias(key)).distinct().join(met, key, "left_anti")


def cluster_quotas(strata: DataFrame, size: int, rule: str = "sqrt") -> DataFrame:
    """``quota`` per stratum (columns stratum, n): equal or in proportion to the square root of n, summing to ``size``.

    A stratum never gets more than it has; its unused slots go to the others by bisecting the scale of the quotas. Whole numbers
    are taken by the largest remainder, equal remainders by a hash of the stratum. Strata with a column ``least`` get so many slots (n at most)
    before the rest is shared out; where ``size`` is below their sum, strata with a true ``firm`` get theirs and of the others the larger get one each. Strata of equal size are handled together:
    the driver sees one row per distinct size, ``least`` and ``firm``.
    """
    if rule not in ("sqrt", "equal"):
        raise ValueError("rule is 'sqrt' or 'equal'")
    if "least" not in strata.columns:
        strata = strata.withColumn("least", F.lit(0).cast("bigint"))
    if "firm" not in strata.columns:
        strata = strata.withColumn("firm", F.lit(False))
    strata = strata.withColumn("least", F.least(F.col("least").cast("bigint"), "n"))
    sizes = strata.groupBy("n", "least", "firm").agg(F.count(F.lit(1)).alias("m")).orderBy("n", "least", "firm").collect()
    if not sizes:
        return strata.select("stratum", F.lit(0).cast("bigint").alias("quota"))
    n, m, least = (np.array([r[c] for r in sizes], float) for c in ("n", "m", "least"))
    firm = np.array([r["firm"] for r in sizes])
    weight = np.sqrt(n) if rule == "sqrt" else np.ones(len(n))
    size = int(min(size, (n * m).sum()))
    if (least * m).sum() > size:
        exact = np.where(firm, least, (least > 0) * weight / (weight.max() + 1))
    else:
        a, b = 0.0, float((n / weight).max())
        for _ in range(200):
            mid = (a + b) / 2
            a, b = (mid, b) if (np.clip(mid * weight, least, n) * m).sum() < size else (a, mid)
        exact = np.clip(b * weight, least, n)
    whole = np.floor(exact + 1e-9)
    open_slots = int(round(size - (whole * m).sum()))
    more = np.zeros(len(n), dtype=int)
    for i in np.argsort(-(exact - whole), kind="stable"):
        if open_slots <= 0:
            break
        if whole[i] < n[i]:
            more[i] = min(open_slots, int(m[i]))
            open_slots -= more[i]
    by_size = strata.sparkSession.createDataFrame([(int(n[i]), int(least[i]), bool(firm[i]), int(whole[i]), bool(more[i] == m[i]), int(more[i])) for i in range(len(n))], "n bigint, least bigint, firm boolean, base bigint, every boolean, some bigint")
    out = cut_lineage(strata.select("stratum", "n", "least", "firm").join(by_size, ["n", "least", "firm"]))
    quota = by_size.filter("not every and some > 0").select("n", F.col("some").alias("quota"))  # one size at most
    rows = out.filter("not every and some > 0").select("stratum", "n", (-F.pmod(F.xxhash64("stratum"), F.lit(1 << 52)) / float(1 << 52)).alias("u"))
    lucky = top_by_cutoff(cut_lineage(rows), "n", "u", "stratum", quota, -1.0, 0.0).filter("kept").select("stratum", F.lit(1).alias("one"))
    return out.join(lucky, "stratum", "left").select("stratum", (F.col("base") + F.col("every").cast("int") + F.coalesce("one", F.lit(0))).alias("quota"))


def clustered(rows: DataFrame, key: str, features: list[str], clusters: int = CLUSTERS, seed: int = 7) -> DataFrame:
    """Rows (materialised) with the ``cluster`` of their nearest mini-batch k-means centre."""
    held = cut_lineage(rows)
    centres = mini_batch_kmeans(held, features, key, clusters, seed=seed)
    return held.withColumn("cluster", nearest(features, centres))


def varied_subset(rows: DataFrame, key: str, group: list[str], features: list[str], size: int | float, radius: float | None = None, rule: str = "sqrt", clusters: int = CLUSTERS, seed: int = 7, hot_rows: int | None = None) -> DataFrame:
    """``size`` records (a float is a share of all) that cover the variety of the table: key, group columns, cluster and ``mandatory``.

    Records are clustered by ``features``; each (group, cluster) is a stratum with a square-root or equal quota, and its records
    of smallest random key are taken. With a ``radius``, records that have no other of their group within it (``mandatory``) form strata of their own
    within group and cluster, whose quota is all they have, and ``size`` grows to their number if it is smaller; quotas and sampling are one for all. Every group without a mandatory record gets a slot, in its largest
    stratum, before the rest is shared out; a warning tells how many groups stay without a record where ``size`` is too small for that. Records without key, features or with NaN are left out; a null group value is a
    group of its own; of a repeated key one record counts. An empty table gives an empty result; a table not larger than ``size`` comes out whole.
    """
    ready = rows.select(F.col(key), *[F.coalesce(F.col(g), F.lit("")).alias(g) for g in group], *[F.col(f).cast("double").alias(f) for f in features]).filter(F.col(key).isNotNull())
    for f in features:
        ready = ready.filter(F.col(f).isNotNull() & ~F.isnan(f))
    ready = ready.groupBy(key).agg(F.min(F.struct(*group, *features)).alias("r")).select(key, "r.*")
    placed = clustered(ready, key, features, clusters, seed)
    if radius is not None:
        alone = isolated(placed, key, group, features, radius).withColumn("mandatory", F.lit(True))
        placed = placed.join(alone, key, "left").withColumn("mandatory", F.coalesce("mandatory", F.lit(False)))
    else:
        placed = placed.withColumn("mandatory", F.lit(False))
    placed = placed.withColumn("stratum", F.xxhash64(*group, "cluster", "mandatory")).withColumn("u", -F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 52)) / float(1 << 52))
    placed = cut_lineage(placed.drop(*features))
    kind = F.array(F.lit(""), *[F.col(g).cast("string") for g in group]).alias("kind")  # also without group columns
    strata = cut_lineage(placed.groupBy(kind, "stratum", "mandatory").agg(F.count(F.lit(1)).alias("n")))
    kinds = strata.groupBy("kind").agg(F.max("mandatory").alias("safe"), F.max(F.struct("n", "stratum")).getField("stratum").alias("largest"))
    counted = strata.agg(F.sum("n"), F.sum(F.when(F.col("mandatory"), F.col("n")))).first()
    every, must = counted[0] or 0, counted[1] or 0
    size = max(round(size * every) if isinstance(size, float) else size, must)
    if (bare := kinds.filter("not safe").count()) > size - must:
        warnings.warn(f"varied_subset: size {size} is too small for every group, {bare - size + must} of them come out without a record", stacklevel=2)
    floor = F.when(F.col("mandatory"), F.col("n")).when(~F.col("safe") & (F.col("largest") == F.col("stratum")), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    floored = strata.join(kinds, "kind").select("stratum", "n", floor.alias("least"), F.col("mandatory").alias("firm"))
    quota = cluster_quotas(cut_lineage(floored), size, rule)
    chosen = top_by_cutoff(placed, "stratum", "u", key, quota, -1.0, 0.0, hot_rows=hot_rows).filter("kept")
    return chosen.select(key, *group, "cluster", "mandatory")


def posed_frames(step4: DataFrame) -> DataFrame:
    """Each frame's latest step-4 row with pose_status ok: frame_id, scene (of its latest row of any status), pose_cell, yaw, pitch; one pass over the report."""
    place = F.struct("reported_at", "seq")
    ok = canonical(F.col("pose_status")) == "ok"
    pose = F.max_by(F.struct("pose_cluster_key", number("pose_yaw").alias("yaw"), number("pose_pitch").alias("pitch")), F.when(ok, place))
    rows = step4.filter(F.col("frame_id").isNotNull()).groupBy("frame_id").agg(pose.alias("p"), F.max_by(F.struct("scene_group", "filename"), place).alias("s")).filter("p is not null")
    return rows.select("frame_id", scene_key(F.col("s.scene_group"), F.col("s.filename")).alias("scene"), canonical(F.col("p.pose_cluster_key")).alias("pose_cell"), "p.yaw", "p.pitch")
