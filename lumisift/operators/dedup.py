"""Near-duplicate frames inside scenes: blocked similarity self-join, clusters and their best frames."""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.math import angle_gap, hamming
from ..functions.names import cluster_label
from ..params import DedupParams
from ..session import cut_lineage
from .graph import component_labels
from .prefix import prefix_counts
from .ranks import best_per_group
from .skew import hot_threshold, skew_join, spread_join

_KEY = ("scene", "shot", "t", "yaw", "pitch", "gh", "fh")
#: Most pieces of a hash that must agree at once; each further one makes keys rarer and more numerous.
LEVELS = 3
#: What a key costs, which is shuffled for a class and its looks around, against a test of two classes.
KEY_COST = 32


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pieces(distance: int, level: int) -> list[int]:
    """Masks of the ``distance + level`` pieces of a 64-bit hash: of two hashes with at most ``distance`` different bits, ``level`` pieces agree."""
    m = distance + level
    edges = [64 * i // m for i in range(m + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def _masks(distance: int, level: int) -> list[int]:
    """Masks of all choices of ``level`` pieces; level 0 compares nothing and so everything."""
    return [_signed(sum(c)) for c in combinations(_pieces(distance, level), level)] if level else [0]


def _level(n: Column, distance: int) -> Column:
    """Level at which a record's keys (times KEY_COST) and the unrelated records met under them are fewest in a cell of ``n`` records with unrelated hashes."""

    def cost(level: int, n: int) -> float:
        return comb(distance + level, level) * (KEY_COST + n * 2.0 ** -(level * (64 // (distance + level))))

    best = [min(range(LEVELS + 1), key=lambda k: cost(k, 1 << e)) for e in range(41)]
    out = F.lit(best[0])
    for e in range(1, len(best)):
        if best[e] != best[e - 1]:
            out = F.when(n >= 1 << e, best[e]).otherwise(out)
    return out


def _spelled(rows: DataFrame, distances: dict[str, int]) -> DataFrame:
    """Rows of a cell with their join keys, one per mask of the cell's level and known hash; at level 0 one key for all."""
    table = [(kind, level, which, m) for kind, d in distances.items() for level in range(LEVELS + 1) for which in ((0, 1) if level else (2,)) for m in _masks(d, level)]
    masks = F.broadcast(rows.sparkSession.createDataFrame(table, "kind string, level int, which int, mask bigint"))
    value = F.when(F.col("which") == 0, F.col("gh")).when(F.col("which") == 1, F.col("fh")).otherwise(F.lit(0).cast("bigint"))
    keyed = rows.join(masks, ["kind", "level"]).withColumn("value", value.bitwiseAND(F.col("mask"))).filter("value is not null")
    return keyed.withColumn("key", F.xxhash64("cell", "which", "mask", "value")).drop("cell", "value")


def _first_mask(distances: dict[str, int]) -> Column:
    """The first choice of pieces on which the matched hashes of ``a`` and ``b`` agree, so that a pair is tested further under one key only."""
    differ = F.when(F.col("a.which") == 0, F.col("a.gh").bitwiseXOR(F.col("b.gh"))).otherwise(F.col("a.fh").bitwiseXOR(F.col("b.fh")))

    def first(pieces: list[int], level: int) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("m"))
        agree = lambda acc, x: F.when((acc["n"] < level) & (differ.bitwiseAND(x) == 0), F.struct((acc["n"] + 1).alias("n"), acc["m"].bitwiseOR(x).alias("m"))).otherwise(acc)
        return F.aggregate(F.array(*[F.lit(_signed(x)).cast("bigint") for x in pieces]), start, agree)["m"]

    out = F.lit(0).cast("bigint")
    for name, distance in distances.items():
        for level in range(1, LEVELS + 1):
            out = F.when((F.col("a.kind") == name) & (F.col("a.level") == level), first(_pieces(distance, level), level)).otherwise(out)
    return out


def _close(a: str, b: str, p: DedupParams) -> Column:
    c = lambda side, x: F.col(f"{side}.{x}")
    gap = angle_gap(c(a, "yaw"), c(a, "pitch"), c(b, "yaw"), c(b, "pitch"))
    steps = F.coalesce(F.abs(c(a, "t") - c(b, "t")), F.lit(999))
    within = lambda most: F.coalesce(hamming(c(a, "gh"), c(b, "gh")) <= most, F.lit(False)) | F.coalesce(hamming(c(a, "fh"), c(b, "fh")) <= most, F.lit(False))
    return ((gap <= p.angle) & (steps <= p.time_window) & within(p.near_hash)) | ((gap <= p.strict_angle) & within(p.phash))


def frame_classes(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of exact copies (rep, size and the compared columns), and the members (seq, rep).

    ``frames`` has seq, scene, shot, t, yaw, pitch, gh and fh. Rows without any hash are left out; a null
    scene or shot is a value like others. Copies are counted on the map side.
    """
    ready = frames.filter("gh is not null or fh is not null").select("seq", F.coalesce("scene", F.lit("")).alias("scene"), F.coalesce("shot", F.lit("")).alias("shot"), *_KEY[2:])
    # One text key for the compared values (null has its own sign), so that a class with very many copies can be joined apart.
    ready = cut_lineage(ready.withColumn("copy_key", F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0002")) for k in _KEY])))
    classes = cut_lineage(ready.groupBy("copy_key", *_KEY).agg(F.min("seq").alias("rep"), F.count(F.lit(1)).alias("size")))
    known = classes.select("copy_key", "rep", "size", F.col("size").alias("rows"))
    count = ready.count()
    members = skew_join(ready.select("copy_key", "seq"), known, ["copy_key"], "rows", hot_threshold(count), F.col("seq"), "inner", count).select("seq", "rep", "size")
    return classes.drop("copy_key"), members


def _distances(p: DedupParams) -> dict[str, int]:
    return {"pose": p.phash, "time": p.near_hash}


def candidates(classes: DataFrame, p: DedupParams) -> tuple[DataFrame, DataFrame]:
    """The classes under the keys of their own cells, and under those of all cells within their reach: what has an equal ``key`` may be near."""
    if not (0 <= p.phash < 32 and 0 <= p.near_hash < 32):
        raise ValueError("phash and near_hash must be below 32")
    if p.strict_angle < 0 or p.angle < 0 or p.time_window < 0:
        raise ValueError("angles and time_window must not be negative")
    # Two hashes of scene and shot stand for the strings; together they are as good as unique.
    keyed = classes.filter("yaw is not null and pitch is not null").select(F.xxhash64("scene", "shot").alias("block"), F.hash("shot", "scene").alias("check"), "rep", F.col("t").cast("bigint").alias("t"), "yaw", "pitch", "gh", "fh")
    distances = _distances(p)

    def cells(kind: str, reach: float, steps: int | None) -> Column:
        """Cells within ``reach`` degrees and ``steps`` of time; with 0 the own cell."""
        wide, span = {"pose": p.strict_angle, "time": p.angle}[kind], 2 * p.time_window + 1
        # As wide as what is within reach of one point, so that the ends of the reach lie in all cells that it touches.
        side = 2 * max(wide, 1e-3)
        spots = lambda c: [F.floor((F.col(c) + x) / side) for x in ((-reach, reach) if reach else (0.0,))]
        slots = [F.lit(0)] if kind == "pose" else [F.floor((F.col("t") + x) / span) for x in ((-steps, steps) if steps else (0,))]
        return F.array_distinct(F.array(*[F.struct(F.lit(kind).alias("kind"), F.xxhash64(F.lit(kind), "block", s, y, q).alias("cell")) for s in slots for y in spots("yaw") for q in spots("pitch")]))

    columns = ("block", "check", "rep", "t", "yaw", "pitch", "gh", "fh")
    timed = lambda x: F.when(F.col("t").isNotNull(), x).otherwise(F.slice(x, 1, 0))
    own = keyed.select(*columns, F.explode(F.concat(cells("pose", 0.0, 0), timed(cells("time", 0.0, 0)))).alias("x")).select(*columns, "x.kind", "x.cell")
    eyes = keyed.select(*columns, F.explode(F.concat(cells("pose", p.strict_angle, 0), timed(cells("time", p.angle, p.time_window)))).alias("x")).select(*columns, "x.kind", "x.cell")
    stored = own.groupBy("cell", "kind").agg(F.count(F.lit(1)).alias("n"))
    looks = eyes.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    level = F.when(F.col("kind") == "pose", _level(F.col("n"), p.phash)).otherwise(_level(F.col("n"), p.near_hash))
    sizes = cut_lineage(stored.join(looks, "cell").filter("m > 1").select("cell", "n", "m", level.cast("int").alias("level")))
    total = keyed.count()
    one = skew_join(own, sizes.select("cell", "n", "level"), ["cell"], "n", hot_threshold(2 * total), F.col("rep"), "inner", 2 * total)
    other = skew_join(eyes, sizes.select("cell", "m", "level"), ["cell"], "m", hot_threshold(12 * total), F.col("rep"), "inner", 12 * total)
    return _spelled(one, distances), _spelled(other, distances)


def near_pairs(classes: DataFrame, p: DedupParams = DedupParams()) -> DataFrame:
    """Pairs (a, b, block) of class representatives that are near duplicates; both orders are one pair, a < b.

    Two blockings inside a scene and shot type, each with the full test behind it, cover the rule exactly: frames alike whatever their time lie in neighbouring
    cells of a pose grid, frames at most ``time_window`` apart in neighbouring cells of time and a wider pose grid. A class is stored in its own
    cell and looks into all cells within reach, so that a pair is met once a blocking. In a full cell only classes that agree in some pieces of a hash
    meet: of ``d + k`` pieces of hashes that differ in ``d`` bits, ``k`` agree, and ``k`` grows with the cell's classes, so that the unrelated classes met by one
    grow far slower than the cell. Frames without a number in their name share one time and so rest on the pose grid and the pieces alone.
    """
    one, other = candidates(classes, p)
    distances = _distances(p)
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.rep") < F.col("b.rep")) & (F.col("a.block") == F.col("b.block")) & (F.col("a.check") == F.col("b.check"))
    met = one.alias("a").join(other.alias("b"), same & _close("a", "b", p) & ((F.col("a.level") == 0) | (F.col("a.mask") == _first_mask(distances))))
    return met.select(F.col("a.block").alias("block"), F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()


def duplicate_links(frames: DataFrame, p: DedupParams = DedupParams()) -> DataFrame:
    """One row per frame with a hash: seq, component (its smallest seq) and links (near duplicates, copies included).

    Only representatives of exact copies are compared; links of copies are counted, not listed. Frames without pose
    angles have no copies or partners.
    """
    classes, members = frame_classes(frames)
    pairs = cut_lineage(near_pairs(classes, p))
    labels = component_labels(classes.select(F.col("rep").alias("node")), pairs, "node", "a", "b", block="block")
    sizes = classes.select(F.col("rep").alias("other"), F.col("size").alias("n"))
    ways = pairs.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    partners = spread_join(ways, sizes, ["other"], F.col("rep"), 2 * pairs.count(), "inner").groupBy("rep").agg(F.sum("n").alias("partners"))
    posed = F.col("yaw").isNotNull() & F.col("pitch").isNotNull()
    own = classes.select("rep", F.col("size").alias("rows"), posed.alias("posed"), F.when(posed, F.col("size") - 1).otherwise(0).alias("copies"))
    per_class = own.join(partners, "rep", "left").join(labels, F.col("rep") == F.col("node"))
    per_class = per_class.select("rep", "rows", "component", "posed", (F.col("copies") + F.coalesce("partners", F.lit(0))).alias("links"))
    count = members.count()
    joined = skew_join(members, per_class, ["rep"], "rows", hot_threshold(count), F.col("seq"), "inner", count)
    return joined.select("seq", F.when(F.col("posed"), F.col("component")).otherwise(F.col("seq")).alias("component"), "links")


def clusters(frames: DataFrame, linked: DataFrame) -> DataFrame:
    """Frames with their cluster: seq, duplicate_group, group_size, group_best, duplicate_status and the distances to the best.

    ``frames`` adds ``quality`` and ``filename`` to what :func:`duplicate_links` reads. The best frame has the highest quality at one decimal, the first of
    equals; clusters are numbered in order of their first frame (by prefix counts, not in one partition).
    """
    q = F.floor(F.col("quality") * 10 + 0.5) / 10
    rows = cut_lineage(frames.join(linked.select("seq", "component"), "seq").withColumn("q1", q))
    best = best_per_group(rows.select("component", "seq", "q1", "filename", "yaw", "pitch", "gh"), ["component"], "q1", "seq")
    sizes = rows.groupBy("component").agg(F.count(F.lit(1)).alias("group_size"), F.min("seq").alias("first"))
    order = prefix_counts(sizes.select(F.lit(0).alias("g"), F.col("first").alias("v"), F.lit(1).cast("bigint").alias("n")), "g", "v", "n")
    # One row per component on both sides of these joins.
    numbered = sizes.join(order.select(F.col("v").alias("first"), (F.col("below") + 1).alias("number")), "first")
    per = numbered.join(best.select("component", F.col("seq").alias("best_seq"), F.col("filename").alias("group_best"), F.col("yaw").alias("by"), F.col("pitch").alias("bp"), F.col("gh").alias("bh")), "component")
    count = rows.count()
    joined = skew_join(rows, per.withColumn("__rows", F.col("group_size")), ["component"], "__rows", hot_threshold(count), F.col("seq"), "inner", count)
    status = F.when(F.col("group_size") == 1, "unique").when(F.col("seq") == F.col("best_seq"), "representative").otherwise("duplicate")
    return joined.select(
        "seq",
        cluster_label(F.col("number"), F.col("scene")).alias("duplicate_group"),
        "group_size",
        "group_best",
        status.alias("duplicate_status"),
        hamming(F.col("gh"), F.col("bh")).alias("phash_distance_to_group_best"),
        angle_gap(F.col("yaw"), F.col("pitch"), F.col("by"), F.col("bp"), 0.0).alias("angle_distance_to_group_best"),
    )


def duplicate_summary(clustered: DataFrame) -> DataFrame:
    """One row: frames, clusters kept, duplicates and the pruned share in ten-thousandths."""
    dup = F.count_if(F.col("duplicate_status") == "duplicate")
    n = F.count(F.lit(1))
    return clustered.agg(n.alias("frames"), (n - dup).alias("kept"), dup.alias("duplicates"), F.floor(dup * 10000 / F.greatest(n, F.lit(1)) + 0.5).cast("bigint").alias("pruned_e4"))
