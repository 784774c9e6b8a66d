"""Connected components: a local union-find over portions of edges, and min-label propagation for what is left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import spread_join

#: Edges that a task unites at once.
PORTION = 1_000_000


def vertex_order(x: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random order of the vertices (splitmix64), so that chains of parents stay short."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def union_find(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of an edge list and the representative (first in the vertex order) of each one's component.

    Union-find by whole arrays: every edge hooks the later of its two roots under the earlier, then all paths are halved until
    they are flat; repeated until no edge joins two roots.
    """
    ids, flat = np.unique(np.concatenate([src, dst]), return_inverse=True)
    order = np.argsort(vertex_order(ids), kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    u, v = place[flat[: len(src)]], place[flat[len(src) :]]
    parent = np.arange(len(ids))
    while len(u):
        low, high = np.minimum(u, v), np.maximum(u, v)
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
        u, v = parent[u], parent[v]
        apart = u != v
        u, v = u[apart], v[apart]
    return ids, ids[order[parent[place]]]


def unite_portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each portion of a partition's edges (two long columns) as links (v, r): a vertex and the representative of its local component."""

    def portions():
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= PORTION:
                yield held
                held, n = [], 0
        if held:
            yield held

    for held in portions():
        src = np.concatenate([b.column(0).to_numpy() for b in held])
        dst = np.concatenate([b.column(1).to_numpy() for b in held])
        ids, rep = union_find(src, dst)
        moved = ids != rep
        yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(rep[moved])], names=["v", "r"])


def component_labels(nodes: DataFrame, edges: DataFrame, node: str = "node", src: str = "src", dst: str = "dst", block: str | None = None, rounds: int = 50) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked to directly or through others; lone nodes are their own.

    Edges that share a ``block`` (such as a scene that no edge leaves) go to one task, which unites them portion by portion; a block that is too full for a
    task is split by the engine. Where every vertex then has one representative that has none itself, the components are found; otherwise the contracted links
    are settled by :func:`propagate_labels`.
    """
    pairs = edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
    ends = [F.col(src).cast("bigint").alias("a"), F.col(dst).cast("bigint").alias("b")]
    placed = pairs.select(*ends, F.col(block).alias("__block")).hint("rebalance", "__block") if block else pairs.select(*ends)
    links = cut_lineage(placed.select("a", "b").mapInArrow(unite_portions, "v bigint, r bigint").distinct())
    several = links.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
    chained = links.select(F.col("r").alias("v")).join(links.select("v"), "v", "left_semi")
    if not several.unionByName(chained).limit(1).count():
        members = links.select("v", "r").unionByName(links.select(F.col("r").alias("v"), "r").distinct())
        least = links.groupBy("r").agg(F.min("v").alias("m")).select("r", F.least("r", "m").alias("component"))
        found = spread_join(members, least, ["r"], F.col("v"), members.count(), "inner").select(F.col("v").alias(node), "component")
    else:
        ids = links.select(F.col("v").alias("n")).unionByName(links.select(F.col("r").alias("n"))).distinct()
        found = propagate_labels(ids, links.select(F.col("v").alias("a"), F.col("r").alias("b")), rounds).select(F.col("n").alias(node), F.col("c").alias("component"))
    return nodes.select(node).filter(F.col(node).isNotNull()).distinct().join(found, node, "left").withColumn("component", F.coalesce("component", node))


def propagate_labels(ids: DataFrame, pairs: DataFrame, rounds: int = 50) -> DataFrame:
    """Smallest reachable node ``c`` of every node ``n`` over the pairs (a, b).

    Each round takes the smallest label among a node's neighbours (combined on the map side), then replaces labels by their labels, so that the distance covered
    doubles. Rounds are cut off from their past by a checkpoint; the loop ends when no label changes.
    """
    links = cut_lineage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(ids.select("n", F.col("n").alias("c")))
    count, nodes = links.count(), labels.count()
    for _ in range(rounds):
        near = spread_join(links, labels.select(F.col("n").alias("b"), "c"), ["b"], F.col("a"), count, "inner").groupBy("a").agg(F.min("c").alias("m"))
        step = labels.join(near, labels.n == near.a, "left").select("n", F.col("c").alias("old"), F.least("c", F.coalesce("m", "c")).alias("c"))
        step = cut_lineage(step)
        jump = step.select(F.col("n").alias("c"), F.col("c").alias("jc"))
        new = cut_lineage(spread_join(step, jump, ["c"], F.col("n"), nodes, "left").select("n", "old", F.least("c", F.coalesce("jc", "c")).alias("c")))
        changed = new.filter("c <> old").limit(1).count()
        labels = new.select("n", "c")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
