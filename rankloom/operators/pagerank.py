"""PageRank over an edge table.

The number of documents N counts sources only. Targets without out-links join in round 1, keep
receiving and pass nothing on, so their share of the mass is lost and ranks need not sum to 1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rankloom.operators.links import EDGES_PER_SLICE, SlicedEdges
from rankloom.session import AlternatingTable, materialise


@dataclass(frozen=True)
class RankResult:
    ranks: DataFrame
    rounds: int
    converged: bool


def initial_ranks(links: DataFrame) -> DataFrame:
    """(doc_id, rank): 1/N for every source."""
    sources = links.select(F.col("src").alias("doc_id")).distinct()
    n = sources.agg(F.count("*").alias("n"))
    return sources.withColumn("rank", F.lit(1.0) / n.scalar())


def _state(edges: SlicedEdges) -> DataFrame:
    """(doc_id, rank, previous, out_degree, slices) of all nodes before round 1."""
    sources = materialise(edges.sources, "rank-sources")
    n = sources.count()
    targets = edges.edges.select(F.col("dst").alias("doc_id")).distinct()
    nodes = sources.withColumnRenamed("src", "doc_id").join(targets, "doc_id", "full_outer")
    is_source = F.col("out_degree").isNotNull()
    return nodes.select(
        "doc_id", F.when(is_source, F.lit(1.0) / max(n, 1)).otherwise(0.0).alias("rank"),
        F.lit(0.0).alias("previous"), "out_degree", "slices", F.lit(n).cast("bigint").alias("n"),
    )


def contributions(state: DataFrame, edges: SlicedEdges) -> DataFrame:
    """(doc_id, received): rank / out-degree summed per target, partly before the shuffle."""
    shares = state.filter(F.col("out_degree").isNotNull()).select(
        F.col("doc_id").alias("src"), "slices", (F.col("rank") / F.col("out_degree")).alias("share")
    )
    return edges.scatter(shares).groupBy(F.col("dst").alias("doc_id")).agg(F.sum("share").alias("received"))


def step(state: DataFrame, edges: SlicedEdges, damping: float = 0.85) -> DataFrame:
    """State after one more round."""
    received = F.coalesce(F.col("received"), F.lit(0.0))
    return state.join(contributions(state, edges), "doc_id", "left").select(
        "doc_id", ((1 - damping) / F.col("n") + damping * received).alias("rank"),
        F.col("rank").alias("previous"), "out_degree", "slices", "n",
    )


def _moved(epsilon: float) -> Column:
    """Whole number of epsilons all nodes moved; below 1 only when every node moved less than one."""
    return F.sum(F.floor(F.abs(F.col("rank") - F.col("previous")) * (1 / epsilon)))


def convergence(state: DataFrame, epsilon: float) -> float:
    """Sum over nodes of the whole number of epsilons they moved, times epsilon."""
    return (state.agg(_moved(epsilon)).first()[0] or 0) * epsilon


def pagerank(links: DataFrame, damping: float = 0.85, epsilon: float = 1e-6, rounds: int | None = None,
             max_rounds: int | None = None, edges_per_slice: int = EDGES_PER_SLICE) -> RankResult:
    """Rank until no node moves by epsilon, or for exactly ``rounds`` rounds.

    Every round is one job: it writes its state to the shared folder and measures the movement
    on the way. Plans stay one round deep and a lost executor costs at most one round again.
    """
    edges = SlicedEdges.build(links, edges_per_slice)
    table = AlternatingTable(links.sparkSession, "rank-state")
    state = edges.beside(table.write(_state(edges)))
    done, converged = 0, False
    limit = rounds if rounds is not None else max_rounds
    while (limit is None or done < limit) and not converged:
        seen = Observation()
        state = edges.beside(table.write(step(state, edges, damping).observe(seen, _moved(epsilon).alias("moved"))))
        done += 1
        if rounds is None:
            converged = (seen.get["moved"] or 0) * epsilon < epsilon
    edges.release()
    started = state if done else state.filter(F.col("out_degree").isNotNull())
    return RankResult(started.select("doc_id", "rank"), done, converged)


def max_rank(ranks: DataFrame) -> DataFrame:
    return ranks.agg(F.greatest(F.max("rank"), F.lit(0.0)).alias("max_rank"))
