"""Breadth-first frontier expansion over a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.ids import first_rows
from rankloom.operators.links import EDGES_PER_SLICE, SlicedEdges
from rankloom.session import materialise


def unseen(candidates: DataFrame, visited: DataFrame, key: str = "node") -> DataFrame:
    """Candidates not visited yet."""
    return candidates.join(visited.select(key), key, "left_anti")


def expand_frontier(links: DataFrame, entries: DataFrame, max_depth: int = 10,
                    edges_per_slice: int = EDGES_PER_SLICE) -> DataFrame:
    """(node, depth) of everything reachable from ``entries`` (node) within ``max_depth`` links.

    Nodes at the depth limit are kept but not expanded. Each depth is written once, so the
    visited set is a union of finished tables.
    """
    edges = SlicedEdges.build(links, edges_per_slice)
    sources = materialise(edges.sources, "frontier-sources")
    frontier = materialise(
        entries.select("node").distinct().withColumn("depth", F.lit(0)), "frontier"
    )
    visited = frontier
    for depth in range(1, max_depth + 1):
        starts = frontier.select(F.col("node").alias("src")).join(sources, "src").select("src", "slices")
        reached = edges.scatter(starts).select(F.col("dst").alias("node")).distinct()
        frontier = materialise(
            unseen(reached, visited).withColumn("depth", F.lit(depth)), "frontier"
        )
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    edges.release()
    return visited


def page_budget(visited: DataFrame, budget: int) -> DataFrame:
    """First ``budget`` nodes by depth, then node."""
    return first_rows(visited, ["depth", "node"], budget)
