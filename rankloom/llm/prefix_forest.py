"""Approximate nearest neighbours: a forest of hash prefixes.

Rows are dealt into shards of bounded size and queries into blocks; a task holds one shard and one block. In a shard
every tree is a sorted array of long hash strings. A query descends each tree to its longest matching prefix, then all
trees ascend together, one bit a step, until enough candidates share a prefix with it. Candidates are compared by true
distance and the nearest of all shards are kept. Every row is in a shard, and no row is held more than once a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 60
#: Rows of a shard and queries of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
#: Most rows that the centre and the scale of the hashes are fitted to.
FIT_ROWS = 10_000


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vector (double) of the rows that take part: no nulls, no zero vector, finite components only."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).filter(good).select(F.col(key).alias("vec_id"), v.alias("vector"))


class Forest:
    """Sorted arrays of hash strings over the rows of a shard."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, trees: int, seed: int):
        rng = np.random.default_rng(seed)
        self._centre = centre
        self._planes = rng.standard_normal((trees, vectors.shape[1], BITS))
        self._orders, self._codes = [], []
        for code in self.hashes(vectors):
            order = np.argsort(code, kind="stable")
            self._orders.append(order)
            self._codes.append(code[order])

    def hashes(self, vectors: np.ndarray) -> np.ndarray:
        """A string of BITS bits per tree and vector, first bit highest."""
        weights = np.left_shift(np.uint64(1), np.arange(BITS - 1, -1, -1, dtype=np.uint64))
        moved = vectors - self._centre
        return np.stack([((moved @ p) > 0).astype(np.uint64) @ weights for p in self._planes])

    def candidates(self, codes: np.ndarray, enough: int) -> np.ndarray:
        """Rows for one query with a hash string per tree: at least ``enough``, or all there are."""
        span = lambda bits: [
            (np.searchsorted(own, (c >> np.uint64(BITS - bits)) << np.uint64(BITS - bits)),
             np.searchsorted(own, ((c >> np.uint64(BITS - bits)) << np.uint64(BITS - bits)) + (np.uint64(1) << np.uint64(BITS - bits))))
            for own, c in zip(self._codes, codes, strict=True)]
        # The trees ascend together: the longest prefix at which they jointly hold enough rows.
        low, high = 0, BITS
        while low < high:
            middle = (low + high + 1) // 2
            if sum(b - a for a, b in span(middle)) >= enough:
                low = middle
            else:
                high = middle - 1
        while True:
            rows = np.unique(np.concatenate([order[a:b] for order, (a, b) in zip(self._orders, span(low), strict=True)]))
            if low == 0 or len(rows) >= enough:
                return rows
            low -= 1


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, forest: Forest, k: int, enough: int) -> Iterator[tuple]:
    """(query id, row id, distance) of the ``k`` nearest candidates of each query, ties to the smaller id."""
    codes = forest.hashes(queries)
    for n in range(len(queries)):
        rows = forest.candidates(codes[:, n], enough)
        distance = np.sqrt(((vectors[rows] - queries[n]) ** 2).sum(1))
        near = np.flatnonzero(ids[rows] != query_ids[n])
        if len(near) > k:
            near = near[distance[near] <= np.partition(distance[near], k - 1)[k - 1]]
        for d, i in sorted(zip(distance[near].tolist(), ids[rows[near]].tolist(), strict=True))[:k]:
            yield int(query_ids[n]), i, d


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 10, trees: int = 48, share: float = 0.45, least: int = 500,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, seed: int = 17,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the ``k`` nearest rows found for each query.

    ``rows`` and ``queries`` have vec_id and vector, as ``usable`` gives them; a row is no neighbour of the query with its
    own id. The trees ascend until a query has candidates of ``share`` of its shard, ``least`` at least. Ties go to the
    smaller id; an id that repeats is taken once, with its smallest distance. Vectors of another length than most are left
    out. Without rows the result is empty; with fewer than ``k`` all are returned.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return rows.sparkSession.createDataFrame([], schema)
    rows, queries = (x.filter(F.size("vector") == length["n"]) for x in (rows, queries))
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(FIT_ROWS)
    centre = np.array([r[0] for r in sample.select(F.posexplode("vector")).groupBy("pos").agg(F.avg("col").alias("c")).orderBy("pos").select("c").collect()])
    shards = max(1, -(-length["count"] // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))

    # A cell is a shard with a block of queries; rows of shards and blocks are dealt by hash, so no key can crowd one.
    own = rows.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias("block"), F.lit(False).alias("asks"))
    asked = queries.select("vec_id", "vector", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")).alias("shard"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block"), F.lit(True).alias("asks"))

    def cell(frame: pd.DataFrame) -> pd.DataFrame:
        asks = frame["asks"].to_numpy()
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        ids = frame["vec_id"].to_numpy()
        vectors = np.array(frame["vector"].tolist(), dtype=np.float64)
        rows_here = vectors[~asks]
        forest = Forest(rows_here, centre, trees, seed)
        found = list(search_shard(ids[~asks], rows_here, ids[asks], vectors[asks], forest, k, max(least, int(share * len(rows_here)))))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = own.unionByName(asked).groupBy("shard", "block").applyInPandas(cell, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    sorted_near = F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k)
    return best.groupBy("query_id").agg(sorted_near.alias("near")).select("query_id", F.posexplode("near").alias("n", "e")).select(
        "query_id", (F.col("n") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))
