"""Problem 4: consolidating pairwise matches into groups, on a two-dimensional grid of edge blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spelling import base_name
from ..operators.graph import PORTION, union_find
from ..operators.skew import hot_threshold, skew_join, spread_join
from ..session import cut_lineage
from .reports import number

#: Edges that one grid cell should hold on average; a fuller one is united in portions, which the next round unites with one another.
CELL_EDGES = 500_000
#: Blocks of vertices at least, whatever the number of edges, so that a round has SIDE x SIDE cells to work on side by side.
SIDE = 4
#: Times the parents of a round are replaced by their parents' parents.
JUMPS = 2
ROUNDS = 60

__all__ = ["connected_components", "report_links", "union_find"]


def _grid(edges: DataFrame, count: int) -> DataFrame:
    """Edges with their cell, the pair of their ends' blocks, and shuffled by it; a cell that is too full is split by the engine.

    A vertex with very many edges is spread over a whole row or column of the grid.
    """
    side = max(SIDE, int(np.ceil(np.sqrt(count / CELL_EDGES))))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(side))
    return edges.select("src", "dst", (block("src") * side + block("dst")).alias("cell")).hint("rebalance", "cell")


def unite_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Local union-find on the edges (src, dst, cell) of each cell: links (v, r) of a vertex and the representative of its component within the cell.

    A task may hold several small cells or a part of a full one; it works them off in portions, each cell of a portion for itself.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def drain() -> Iterator[pa.RecordBatch]:
        src, dst, cell = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3))
        order = np.argsort(cell, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0])
        for part in np.split(order, starts[1:]):
            ids, rep = union_find(src[part], dst[part])
            moved = ids != rep
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(rep[moved])], names=["v", "r"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= PORTION:
            yield from drain()
            held, rows = [], 0
    if held:
        yield from drain()


def connected_components(edges: DataFrame, src: str, dst: str, hot_rows: int | None = None) -> DataFrame:
    """``node`` and ``group_id`` (smallest node of its group) for every node that has an edge to another.

    Nodes are longs; edges with a null end and self-loops are left out, repeated ones count once. Each
    round cuts the edges into grid cells, unites every cell by a local union-find, exchanges the representatives a vertex
    got in its row and column of the grid (the first in a fixed random order becomes its parent, and the
    representatives of one vertex are linked to it), and goes on with the links between different parents. Vertices
    that have a parent leave the graph, so that the edges shrink by a constant factor each
    round; the loop ends when no link is left, that is when the parents are stable. What a round produces is written to the shared folder. The vertices of a giant component share a
    representative; they are joined to it in parts (:func:`spread_join`).
    An empty table gives an empty result.
    """
    ends = edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).cast("bigint").alias("a"), F.col(dst).cast("bigint").alias("b"))
    pairs = ends.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
    pairs = pairs.filter("src is not null and dst is not null and src <> dst").distinct()
    graph = cut_lineage(pairs)
    count = graph.count()
    first = lambda c: F.min_by(c, F.xxhash64(c))
    labels, nodes = None, 0
    for _ in range(ROUNDS):
        if not count:
            break
        links = cut_lineage(_grid(graph, count).mapInArrow(unite_cells, "v bigint, r bigint"))
        found = links.count()
        parents = links.groupBy("v").agg(first("r").alias("p"))
        for _ in range(JUMPS):
            up = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            parents = spread_join(parents, up, ["p"], F.col("v"), found, "left", hot_rows).select("v", F.coalesce("pp", "p").alias("p"))
        parents = cut_lineage(parents)
        # A vertex's other representatives and its parent, each moved to where it stands now.
        new = spread_join(links, parents, ["v"], F.col("r"), found, "inner", hot_rows).select(F.col("p").alias("a"), F.col("r").alias("b"))
        moved = parents.select(F.col("v").alias("b"), F.col("p").alias("q"))
        new = spread_join(new, moved, ["b"], F.col("a"), found, "left", hot_rows).select("a", F.coalesce("q", "b").alias("b"))
        new = new.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).filter("src <> dst").distinct()
        if labels is None:
            own = parents.select(F.col("v").alias("node"), F.col("p").alias("root"))
            roots = links.select(F.col("r").alias("node")).distinct().join(parents.select(F.col("v").alias("node")), "node", "left_anti").select("node", F.col("node").alias("root"))
            labels = cut_lineage(own.unionByName(roots))
            nodes = labels.count()
        else:
            step = parents.select(F.col("v").alias("root"), F.col("p").alias("next"))
            labels = cut_lineage(spread_join(labels, step, ["root"], F.col("node"), nodes, "left", hot_rows).select("node", F.coalesce("next", "root").alias("root")))
        graph = cut_lineage(new)
        count = graph.count()
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    if labels is None:
        return graph.select(F.col("src").alias("node"), F.col("dst").alias("group_id"))
    smallest = labels.groupBy("root").agg(F.min("node").alias("group_id"), F.count(F.lit(1)).alias("rows"))
    return skew_join(labels, smallest, ["root"], "rows", hot_threshold(nodes, hot_rows), F.col("node"), "inner", nodes).select("node", "group_id")


def report_links(step5: DataFrame, phash_most: int = 14, angle_most: float = 12.0) -> DataFrame:
    """Links (``src``, ``dst``) of frames to the frame their ``group_best`` names, row by row.

    A name counts by its last segment, letter case and blanks aside. Rows whose name is missing or names no frame or the frame
    itself, and rows without both distances or with one too great (or NaN), give no link.
    """
    frames = step5.select(F.lower(base_name(F.col("filename"))).alias("name"), "frame_id").filter("frame_id is not null and name <> ''")
    frames = frames.groupBy("name").agg(F.min("frame_id").alias("dst"))
    angle = number("angle_distance_to_group_best")
    rows = step5.filter((F.col("phash_distance_to_group_best") <= phash_most) & (angle <= angle_most) & F.col("frame_id").isNotNull())
    rows = rows.select(F.col("frame_id").alias("src"), F.lower(base_name(F.col("group_best"))).alias("name")).filter("name <> ''").distinct()
    rows = cut_lineage(rows)
    named = rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows")).join(frames, "name")
    count = rows.count()
    return skew_join(rows, named, ["name"], "rows", hot_threshold(count), F.col("src"), "inner", count).select("src", "dst").filter("src <> dst")
