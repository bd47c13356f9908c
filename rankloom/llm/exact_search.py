"""Exact search for the highest inner products, term by term.

A vector is a sparse row: component t, turned into a whole number, is the weight of term t. Candidates are dealt into
shards of bounded size; a task turns its shard into posting lists, one per term, and then lets all queries stream past.
Each query row scatters its weights, times those of the postings, into a dense array with one score per candidate. The
best of the array are found by partition selection, and the lists of all shards are merged. Nothing is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most components of a shard on average (8 bytes each), and the rows below which a shard isn't cut further.
SHARD_CELLS, LEAST_ROWS = 1 << 23, 4096
#: Whole numbers up to here are exact in a double.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and vector (double) of the rows with an id and a vector without null or non-finite components."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).filter(good).select(F.col(key).cast("long").alias("vec_id"), v.alias("vector"))


def weights(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of all components, one vector after another, and the bounds of the vectors."""
    bounds = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])
    limit = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False)), -limit, limit), bounds


class Postings:
    """Posting lists of a shard, with its rows in the order of their ids."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, bounds: np.ndarray):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        self._own = ids[order]
        self.ids, self._first = np.unique(self._own, return_index=True)
        sizes = np.diff(bounds)
        self.largest = float(np.abs(values).max(initial=0))
        term = np.arange(len(values)) - np.repeat(bounds[:-1], sizes)
        by_term = np.argsort(term, kind="stable")
        ends = np.cumsum(np.bincount(term, minlength=1)) if len(term) else np.zeros(1, np.int64)
        row = np.repeat(place, sizes)
        self._lists: list[tuple[np.ndarray | None, np.ndarray]] = []
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            rows, weight = row[by_term[a:b]], values[by_term[a:b]]
            there = weight != 0
            if 2 * np.count_nonzero(there) >= len(ids):  # a list of most rows is kept with its gaps: no row numbers needed
                full = np.zeros(len(ids))
                full[rows] = weight
                self._lists.append((None, full))
            else:
                self._lists.append((rows[there], weight[there]))
        self._part = np.empty(len(ids))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Inner product of a query with each row; ids that repeat have the highest of their rows."""
        terms = np.flatnonzero(query[: len(self._lists)])
        if float(np.abs(query).max(initial=0)) * self.largest * max(1, len(terms)) < EXACT:
            total = np.zeros(len(self._own))
            for t in terms:
                rows, weight = self._lists[t]
                if rows is None:
                    np.multiply(weight, query[t], out=self._part)
                    total += self._part
                else:
                    total[rows] += query[t] * weight
            total = total.astype(np.int64)
        else:  # whole numbers of any size
            total = np.array([0] * len(self._own), dtype=object)
            for t in terms:
                rows, weight = self._lists[t]
                total[slice(None) if rows is None else rows] += np.array([int(x) for x in weight], dtype=object) * int(query[t])
            total = np.array([max(-LONG - 1, min(LONG, x)) for x in total], dtype=np.int64)
        return total if len(self.ids) == len(self._own) else np.maximum.reduceat(total, self._first)

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the ``k`` highest, ties to the smaller id, without the query's own id."""
        scores, ids = self.scores(query), self.ids
        own = np.searchsorted(ids, query_id)
        if own < len(ids) and ids[own] == query_id:
            scores, ids = np.delete(scores, own), np.delete(ids, own)
        if len(ids) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            above = np.flatnonzero(scores > least)
            chosen = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
            return ids[chosen], scores[chosen]
        return ids, scores


def search_shard(batches: Iterator[pa.RecordBatch], k: int, scale: float) -> Iterator[pa.RecordBatch]:
    """The rows of a shard come first, then all queries in batches; gives the ``k`` best of the shard for each."""
    ids, values, sizes, postings = [], [], [], None
    for batch in batches:
        split = batch.num_rows - (batch.column("asks").true_count)
        own, asked = batch.slice(0, split), batch.slice(split)
        if split:
            value, bounds = weights(own.column("vector"), scale)
            ids.append(own.column("vec_id").to_numpy())
            values.append(value)
            sizes.append(np.diff(bounds))
        if not asked.num_rows or not ids:
            continue
        if postings is None:
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            postings = Postings(np.concatenate(ids), np.concatenate(values), bounds)
            values.clear()
        value, bounds = weights(asked.column("vector"), scale)
        query_ids = asked.column("vec_id").to_numpy()
        found = [postings.best(q, value[a:b], k) for q, a, b in zip(query_ids, bounds[:-1], bounds[1:], strict=True)]
        score = np.concatenate([s for _, s in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(query_ids, [len(i) for i, _ in found])), pa.array(np.concatenate([i for i, _ in found])), pa.array(score)],
            names=["query_id", "vec_id", "score"])


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, shard_cells: int = SHARD_CELLS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` rows with the highest inner product with each query, highest first.

    ``rows`` and ``queries`` have vec_id and vector, as ``usable`` gives them; components count as floor(scale * x). Ties go
    to the smaller id. A row is no candidate of a query with its own id. Rows that share an id are one candidate, or one
    query, with the highest of their scores. Missing components of a shorter vector count as 0, and an empty vector scores 0
    with all. Scores beyond a long are cut to its limits before they are ranked. Without rows the result is empty; with fewer than ``k``
    candidates all are returned.

    Shards hold a bounded number of components, so a task's memory doesn't grow; each query is sent to each shard once.
    Rows are dealt by a hash of id, vector and input partition, so neither repeated ids nor equal vectors crowd a shard.
    """
    spark = rows.sparkSession
    size = rows.agg(F.count("*").alias("n"), F.sum(F.size("vector").cast("long") + 1).alias("cells")).first()
    wanted = min(2 * spark.sparkContext.defaultParallelism, -(-size["n"] // least_rows))
    shards = max(1, wanted, -(-(size["cells"] or 0) // shard_cells))
    own = rows.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", "vector", F.spark_partition_id()), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"))
    asked = queries.select("vec_id", "vector", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"))
    cells = own.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "asks")
    found = cells.select("vec_id", "vector", "asks").mapInArrow(lambda batches: search_shard(batches, k, scale), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same result in SQL, over ``embeddings``.
ORACLE = """
    WITH w AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.w, v.w) AS BIGINT) AS score
          FROM w q JOIN w v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
