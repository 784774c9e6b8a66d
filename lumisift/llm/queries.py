"""Queries of the training-data problems over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.tables import table
from . import capping, components, mixing, packing, quotas, ranking, reading, reports, survivors, tokens, variety

#: Tokens of a container.
CAPACITY = 2048
#: Share of the posed frames in the varied subset, and the largest share of a scene in the share-capped set.
SUBSET = 0.3
SHARE = 0.05
#: Share of the greatest entropy that a mix by temperature aims at.
ENTROPY = 0.9


def scene_scores(spark: SparkSession, d: str) -> DataFrame:
    """Frames with a possible candidate score, and their scene."""
    step7 = table(spark, d, "step7_dataset_report")
    value = reports.latest(step7.select("frame_id", "reported_at", "seq", "filename", reports.candidate_score().alias("score")).filter("score is not null"), ["frame_id"], ["score", "filename"])
    scenes = reports.frame_scenes(table(spark, d, "step4_dataset_report"))
    named = value.join(scenes, "frame_id", "left")
    return named.select("frame_id", "score", F.coalesce("scene", reports.scene_key(F.lit(None).cast("string"), F.col("filename"))).alias("scene"))


def scene_limit():
    """15 frames for scenes named after a reference or an identity, else 8."""
    return F.when(F.col("scene").contains("reference") | F.col("scene").contains("identity"), 15).otherwise(8)


def p1_flagged(spark, d):
    return capping.cap_contributors(scene_scores(spark, d), "scene", "score", "frame_id", scene_limit(), low=0.0, high=110.0)


def p1_found(spark, d):
    return p1_flagged(spark, d).filter("not kept").select("frame_id")


def p1_capped(spark, d):
    return p1_flagged(spark, d).filter("kept").select("scene", "frame_id", "score")


def p1_share_capped(spark, d):
    flagged = capping.cap_contributors(scene_scores(spark, d), "scene", "score", "frame_id", max_share=SHARE, low=0.0, high=110.0)
    return flagged.groupBy("scene").agg(F.count(F.lit(1)).alias("frames"), F.count_if("kept").alias("kept_frames"))


def four_scores(spark, d):
    """Frames with all four scores; brightness as its negative distance from 140."""
    step3 = table(spark, d, "step3_dataset_report").filter(F.col("frame_id").isNotNull())
    place = F.struct("reported_at", "seq")
    last = lambda v: F.max_by(v, F.when(v.isNotNull(), place))
    parts = [
        reports.latest_value(table(spark, d, "step7_dataset_report"), reports.candidate_score(), "score"),
        reports.latest_value(table(spark, d, "step6_dataset_report"), reports.similarity(), "similarity"),
        step3.groupBy("frame_id").agg(last(reports.brightness()).alias("bright"), last(reports.face_dimension()).alias("dim")).filter("bright is not null and dim is not null"),
    ]
    rows = parts[0].join(parts[1], "frame_id").join(parts[2], "frame_id")
    return rows.select("frame_id", "score", "similarity", (-F.round(F.abs(F.col("bright") - 140.0), 1)).alias("brightness"), "dim")


SCORES = {"score": 0.4, "similarity": 0.3, "brightness": 0.15, "dim": 0.15}


def p2_combined(spark, d):
    return ranking.combine_scores(four_scores(spark, d), "frame_id", SCORES)


def p2_found(spark, d):
    """The head of the combined ranking, of which those count that reach the head's beginning on every score."""
    return p2_combined(spark, d).filter("head_combined").filter("head_all").select("frame_id")


def p2_percentiles(spark, d):
    return p2_combined(spark, d).select("frame_id", *[f"{c}_better" for c in SCORES], "n")


def p2_ranking(spark, d):
    return ranking.with_rank(p2_combined(spark, d), "frame_id").select("frame_id", *[f"{c}_pct" for c in SCORES], "combined", "rank")


def p3_found(spark, d):
    return survivors.choose_survivors(table(spark, d, "step5_dataset_report")).select("run_id", "duplicate_group", "frame_id")


def p3_survivors(spark, d):
    return survivors.fill_survivors(table(spark, d, "step5_dataset_report"))


def p3_origin(spark, d):
    """What a survivor takes from the frame's own latest row."""
    return p3_survivors(spark, d).select("run_id", "duplicate_group", "frame_id", "face_quality_score", "frames", "seq", "filename", "temporal_index")


def p4_found(spark, d):
    links = components.report_links(table(spark, d, "step5_dataset_report"))
    return components.connected_components(links, "src", "dst").select(F.col("node").alias("frame_id"), "group_id")


def p4_sizes(spark, d):
    return p4_found(spark, d).groupBy("group_id").agg(F.count(F.lit(1)).alias("frames"))


def p5_subset(spark, d):
    rows = variety.posed_frames(table(spark, d, "step4_dataset_report"))
    return variety.varied_subset(rows, "frame_id", ["scene", "pose_cell"], ["yaw", "pitch"], SUBSET, radius=12.0)


def p5_found(spark, d):
    """The rows of the varied subset that were drawn from the strata of lone poses."""
    return p5_subset(spark, d).filter("mandatory").select("frame_id")


def p5_kinds(spark, d):
    """Posed frames, lone ones and whether the subset shows the kind, per scene and pose cell."""
    rows = cut_lineage(variety.posed_frames(table(spark, d, "step4_dataset_report")))
    chosen = variety.varied_subset(rows, "frame_id", ["scene", "pose_cell"], ["yaw", "pitch"], SUBSET, radius=12.0)
    by = ["scene", "pose_cell"]
    posed = rows.filter("yaw is not null and pitch is not null and not isnan(yaw) and not isnan(pitch)").groupBy(*by).agg(F.count(F.lit(1)).alias("frames"))
    shown = chosen.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if("mandatory").alias("lone"))
    return posed.join(shown, by, "left").select(*by, "frames", F.coalesce("lone", F.lit(0)).alias("lone"), (F.coalesce("n", F.lit(0)) > 0).alias("shown"))


def p6_report(spark, d):
    members = quotas.cell_members(table(spark, d, "step7_dataset_report"))
    return quotas.quota_report(members, quotas.cell_targets(table(spark, d, "quota_targets"))).select("request_id", "quota_cell", "available", "needed", "quota", "shortfall", "unmet")


def p6_found(spark, d):
    return p6_report(spark, d).filter("unmet").select("request_id", "quota_cell")


def p6_cells(spark, d):
    return p6_report(spark, d).select("request_id", "quota_cell", "available", "unmet")


def p6_sample(spark, d):
    members = quotas.cell_members(table(spark, d, "step7_dataset_report"))
    report = quotas.quota_report(members, quotas.cell_targets(table(spark, d, "quota_targets")))
    return quotas.draw_sample(members, report, "frame_id")


def p6_drawn(spark, d):
    """Frames drawn per request and category."""
    return p6_sample(spark, d).groupBy("request_id", "category").agg(F.count(F.lit(1)).alias("drawn"), F.countDistinct("frame_id").alias("frames"))


def p7_pack(spark, d):
    return packing.pack(tokens.document_sizes(table(spark, d, "documents")), "doc_id", "n_tokens", CAPACITY)


def p7_report(spark, d):
    return packing.container_report(p7_pack(spark, d), CAPACITY)


def p7_pieces(spark, d):
    """Pieces and units per document, packed by the size rule of characters: nothing is lost, and only what is longer than a container is cut."""
    packed = packing.pack(tokens.character_sizes(table(spark, d, "documents")), "doc_id", "n_tokens", CAPACITY)
    return packed.groupBy("doc_id").agg(F.count("container").alias("pieces"), F.sum("length").alias("units"))


def p7_audit(spark, d):
    """One row by the size rule of characters: all units, no container too full, and at most a hundredth more containers than the units need."""
    packed = packing.pack(tokens.character_sizes(table(spark, d, "documents")), "doc_id", "n_tokens", CAPACITY)
    r = packing.container_report(packed, CAPACITY)
    return r.select(F.col("tokens").alias("units"), (F.col("fullest") <= CAPACITY).alias("fits"), (F.col("containers") <= F.ceil(F.col("tokens") / CAPACITY * 1.01)).alias("dense"))


def p8_plan(spark, d):
    return mixing.mix_plan(tokens.document_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets"))


def p8_found(spark, d):
    """Sources that the realised mix has used up and that stay below their target."""
    return p8_report(spark, d).filter("unmet").select("mix_id", "source")


def p8_mix(spark, d):
    sizes = _sizes(spark, d)
    return mixing.realise(sizes, mixing.mix_plan(sizes, table(spark, d, "mix_targets")))


def p8_report(spark, d):
    sizes = _sizes(spark, d)
    plan = mixing.mix_plan(sizes, table(spark, d, "mix_targets"))
    return mixing.mix_report(plan, mixing.realise(sizes, plan))


def p8_budgets(spark, d):
    """The plan by the size rule of characters: what each source has, what it should give and what it is asked for."""
    plan = mixing.mix_plan(tokens.character_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets"))
    return plan.select("mix_id", "source", "available_tokens", F.floor(F.col("target_tokens") + 0.5).cast("bigint").alias("target"), F.floor(F.col("budget") + 0.5).cast("bigint").alias("budget"), "short")


def p8_temperature(spark, d):
    """Temperature weights by the size rule of characters, in place of the target weights: under the repetition limit, and at nine tenths of the greatest entropy."""
    sizes = cut_lineage(tokens.character_sizes(table(spark, d, "documents")))
    bare = table(spark, d, "mix_targets").withColumn("target_weight", F.lit(None).cast("double"))
    many = bare.groupBy("mix_id").agg((F.ln(F.count(F.lit(1)).cast("double")) * ENTROPY).alias("entropy_target"))
    plans = [mixing.mix_plan(sizes, bare).withColumn("rule", F.lit("limit")), mixing.mix_plan(sizes, bare.join(F.broadcast(many), "mix_id")).drop("entropy_target").withColumn("rule", F.lit("entropy"))]
    e6 = lambda c: F.floor(F.col(c) * 1e6 + 0.5).cast("bigint").alias(f"{c}_e6")
    return plans[0].unionByName(plans[1]).withColumnRenamed("target_weight", "weight").select("mix_id", "source", "rule", e6("exponent"), e6("weight"))


def _sizes(spark, d):
    return cut_lineage(tokens.document_sizes(table(spark, d, "documents")))


def p9_levels(spark, d):
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))


def p9_found(spark, d):
    return p9_levels(spark, d).filter(F.col("level") >= reading.DEMANDING).select("doc_id")


def p9_profile(spark, d):
    """Documents and words per rounded level."""
    level = F.floor(F.col("level") + 0.5).cast("int")
    return p9_levels(spark, d).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every ``pN_`` query by name."""
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(v) and k not in ("p1_flagged", "p2_combined", "p8_plan")}
