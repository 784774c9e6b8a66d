"""Problem 8: mixing sources to target weights, with capped repetition and budgeted block permutations."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spelling import canonical
from ..operators.skew import hot_threshold, skew_join
from ..session import cut_lineage

#: Power of two of the hash blocks at most: those of a mix and source are put in order by one task, and 65,536 of a few bytes each are no burden.
MOST_BLOCKS = 16


def exponentiate(shares: np.ndarray, exponent: float) -> np.ndarray:
    """Shares to the power ``exponent``, summing to 1; empty sources stay empty at any exponent."""
    safe = np.where(shares > 0, shares, 1.0)
    out = np.where(shares > 0, safe**exponent, 0.0)
    return out / out.sum() if out.sum() > 0 else out


def entropy(shares: np.ndarray) -> float:
    p = shares[shares > 0]
    return float(-(p * np.log(p)).sum())


def temperature_weights(tokens: np.ndarray, entropy_target: float | None = None, total: float | None = None, caps: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """Exponent in [0, 1] and weights: source token shares, exponentiated.

    With ``entropy_target`` the exponent is bisected until the weights have that entropy (flatter = more). With
    ``total`` and ``caps`` it is the smallest exponent, that is the flattest mix, under which no source is asked for more than its cap.
    A target outside what the exponents can give yields the nearest end.
    """
    shares = tokens / tokens.sum() if tokens.sum() > 0 else tokens.astype(float)
    if entropy_target is not None:
        fits = lambda x: entropy(exponentiate(shares, x)) <= entropy_target
    else:
        fits = lambda x: bool((exponentiate(shares, x) * total <= caps * (1 + 1e-12)).all())
    low, high = 0.0, 1.0
    if fits(low):
        return low, exponentiate(shares, low)
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high, exponentiate(shares, high)


def spread_deficit(weights: np.ndarray, spare: np.ndarray, deficit: float) -> tuple[float, np.ndarray]:
    """Extra budgets that hand ``deficit`` to the sources with spare capacity: exponent and budgets.

    Shares are target weights^(1 - x) times spare shares^x with the smallest exponent x in [0, 1] at which no source passes
    its repetition limit: 0 keeps the targets' proportions, 1 is always possible.
    """
    deficit = min(deficit, spare.sum())
    if deficit <= 0:
        return 0.0, np.zeros(len(weights))
    open_ = spare > 0
    w = np.where(open_ & (weights > 0), weights, np.where(open_, 1e-12, 0.0))
    s = spare / spare.sum()

    def shares(x: float) -> np.ndarray:
        out = np.where(open_, np.where(open_, w, 1.0) ** (1 - x) * np.where(open_, s, 1.0) ** x, 0.0)
        return out / out.sum()

    fits = lambda x: bool((shares(x) * deficit <= spare * (1 + 1e-9)).all())
    low, high = 0.0, 1.0
    if fits(low):
        return low, shares(low) * deficit
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high, np.minimum(shares(high) * deficit, spare)


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("source_key", kind="stable")
    total = float(np.nan_to_num(pdf["total_tokens"].max()))
    available = pdf["available_tokens"].to_numpy(float)
    caps = available * pdf["max_repeats"].fillna(0).clip(lower=0).to_numpy(float)
    weights = pdf["target_weight"].to_numpy(float)
    if np.isnan(weights).all():  # no targets: the mix of a given entropy, or the flattest within the repetition limit
        aim = pdf["entropy_target"].max() if "entropy_target" in pdf else math.nan
        exponent, weights = temperature_weights(available, None if np.isnan(aim) else aim, total, caps)
        pdf["target_weight"] = weights
    else:
        exponent, weights = None, np.nan_to_num(weights)
    want = weights * total
    base = np.minimum(want, caps)
    x, extra = spread_deficit(weights, caps - base, want.sum() - base.sum())
    pdf["target_tokens"] = np.round(want, 6)
    pdf["short"] = caps < np.round(want, 6)
    pdf["budget"] = base + extra
    pdf["exponent"] = x if exponent is None else exponent
    return pdf


def mix_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Token budgets per mix and source: the rows of ``targets`` with available_tokens, target_tokens, short, budget, exponent.

    ``sizes`` has doc_id, source and n_tokens; sources agree by letters and digits. ``short`` marks a source whose texts, all taken
    ``max_repeats`` times, stay below target_weight * total_tokens. Its budget is that limit, and what is missing goes to
    the other sources (:func:`spread_deficit`); a mix without weights gets temperature weights, those of the entropy in a column ``entropy_target`` of
    ``targets`` or, without one, the flattest ones within the repetition limit. Tokens are summed on the map side.
    """
    tokens = sizes.groupBy(canonical(F.col("source")).alias("source_key")).agg(F.sum("n_tokens").alias("available_tokens"), F.count(F.lit(1)).alias("available_docs"))
    aims = [F.col("entropy_target").cast("double").alias("entropy_target")] if "entropy_target" in targets.columns else []
    rows = targets.select("mix_id", "source", F.col("target_weight").cast("double").alias("target_weight"), "max_repeats", "total_tokens", *aims, canonical(F.col("source")).alias("source_key")).join(tokens, "source_key", "left")
    rows = rows.withColumn("available_tokens", F.coalesce("available_tokens", F.lit(0)).cast("bigint")).withColumn("available_docs", F.coalesce("available_docs", F.lit(0)).cast("bigint"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.groupBy("mix_id").applyInPandas(_plan, ", ".join([*fields, "target_tokens double", "short boolean", "budget double", "exponent double"]))


def realise(sizes: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of each mix: mix_id, source, doc_id, n_tokens, copies (how often the text is taken).

    ``sizes`` is materialised by the caller. A source's budget is so many whole passes over its texts plus a part of one more. For that part its
    texts lie in hash blocks; the blocks are taken in a random order of the mix as long as they fit the budget, and only in the block that passes it the
    texts are taken one by one, in random order, up to the one nearest to the budget. Texts without tokens come with the passes. No text is taken more than max_repeats times.
    """
    total = sizes.count()
    blocks = 1 << min(MOST_BLOCKS, max(6, math.ceil(math.log2(max(1, total / 10_000)))))
    keyed = sizes.filter(F.col("doc_id").isNotNull()).withColumn("source_key", canonical(F.col("source"))).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(blocks)))
    open_ = cut_lineage(plan.filter("budget > 0 and available_tokens > 0").select("mix_id", F.col("source").alias("named"), "source_key", "available_tokens", "available_docs", "budget", "max_repeats"))
    passes = F.least(F.floor(F.col("budget") / F.col("available_tokens") + 1e-9), F.col("max_repeats")).cast("bigint")
    open_ = open_.withColumn("passes", passes).withColumn("part", F.when(F.col("passes") < F.col("max_repeats"), F.col("budget") - F.col("passes") * F.col("available_tokens")).otherwise(F.lit(0.0)))
    by_block = keyed.groupBy("source_key", "block").agg(F.sum("n_tokens").alias("tokens")).join(open_.select("mix_id", "source_key", "part"), "source_key")
    order = Window.partitionBy("mix_id", "source_key").orderBy(F.xxhash64(F.lit(seed), "mix_id", "block"), "block")
    by_block = by_block.withColumn("ahead", F.sum("tokens").over(order) - F.col("tokens"))
    by_block = by_block.filter(F.col("ahead") < F.col("part")).select("source_key", "block", "mix_id", (F.col("part") - F.col("ahead")).alias("room"), (F.col("ahead") + F.col("tokens") <= F.col("part")).alias("whole"))
    mixes = open_.groupBy("source_key").agg(F.max("available_docs").alias("rows"), F.collect_list(F.struct("mix_id", "named", "passes")).alias("mixes"))
    docs = skew_join(keyed, mixes, ["source_key"], "rows", hot_threshold(total), F.col("doc_id"), "inner", total).withColumn("m", F.explode("mixes"))
    docs = docs.select("source_key", "block", "doc_id", "n_tokens", F.col("m.mix_id").alias("mix_id"), F.col("m.named").alias("source"), F.col("m.passes").alias("passes"))
    on = ["mix_id", "source_key", "block"]
    by_block = cut_lineage(by_block)
    kept = ["mix_id", "source", "doc_id", "n_tokens", "copies"]
    settled = docs.join(by_block, on, "left").filter(F.coalesce("whole", F.lit(True))).withColumn("copies", F.col("passes") + F.coalesce("whole", F.lit(False)).cast("bigint"))
    # Only the one block of a mix and source that passes the budget is put in order.
    border = docs.join(by_block.filter("not whole"), on)
    inside = Window.partitionBy(*on).orderBy(F.xxhash64(F.lit(seed), "mix_id", "doc_id"), "doc_id")
    border = border.withColumn("ahead", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))
    border = border.withColumn("copies", F.col("passes") + (F.col("ahead") + F.col("n_tokens") / 2 <= F.col("room")).cast("bigint"))
    return settled.select(*kept).unionByName(border.select(*kept)).filter("copies > 0")


def mix_report(plan: DataFrame, drawn: DataFrame) -> DataFrame:
    """Target and reached tokens and shares per mix and source; ``unmet`` marks a source that was taken whole, as often as it may be, and stays below its target. In a mix that reaches nothing the shares are 0."""
    got = drawn.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("reached_tokens"), F.max("copies").alias("most_copies"), F.count(F.lit(1)).alias("docs"))
    rows = plan.join(got, ["mix_id", "source"], "left")
    whole = Window.partitionBy("mix_id")
    reached = F.coalesce(F.col("reached_tokens"), F.lit(0))
    used_up = reached >= F.col("available_tokens") * F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))
    return rows.select(
        "mix_id", "source", "target_weight", "target_tokens", "available_tokens", "max_repeats", "short", "budget", "exponent", reached.alias("reached_tokens"), (reached / F.greatest(F.sum(reached).over(whole), F.lit(1))).alias("reached_share"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"), (used_up & (reached < F.col("target_tokens"))).alias("unmet"),
    )
