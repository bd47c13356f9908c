"""Dense row numbers and even splits without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_dense_index(df: DataFrame, order: Sequence[str | Column], name: str = "index") -> DataFrame:
    """Add ``name`` = 0, 1, 2 ... in ``order``.

    Rows are range-partitioned and sorted, and every task numbers its own rows. One count per
    task, summed up, gives the offset of each task. The sorted rows are written first: range
    boundaries are sampled, so computing them twice could place rows differently.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    mark = "_mark"
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(mark, F.monotonically_increasing_id())
    )
    placed = materialise(placed, "dense-index")
    task = F.shiftrightunsigned(F.col(mark), _ROW_BITS)
    # One row per task, a few thousand at most: counted by Spark, summed and sent back as literals.
    counts = sorted(placed.groupBy(task.alias("task")).count().collect())
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["task"], total))
        total += row["count"]
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("bigint")).drop(mark)
    starts = df.sparkSession.createDataFrame(offsets, "task bigint, start bigint")
    return (
        placed.withColumn("task", task).join(F.broadcast(starts), "task")
        .withColumn(name, F.col("start") + F.col(mark).bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("task", "start", mark)
    )


def split_size(rows: int, workers: int, worker: int) -> int:
    """Rows of one worker: the first ``rows mod workers`` workers take one more."""
    return rows // workers + (worker < rows % workers)


def even_split(df: DataFrame, index: str, rows: int, workers: int, name: str = "worker") -> DataFrame:
    """Assign contiguous slices of a dense index to workers, sizes as in ``split_size``."""
    small, larger = divmod(rows, workers)
    boundary = larger * (small + 1)
    i = F.col(index)
    late = F.lit(larger) + F.floor((i - boundary) / F.lit(max(small, 1)))
    return df.withColumn(
        name, F.when(i < boundary, F.floor(i / F.lit(small + 1))).otherwise(late).cast("int")
    )


def first_rows(df: DataFrame, order: Sequence[str | Column], budget: int) -> DataFrame:
    """First ``budget`` rows in ``order``, for budgets too large for one sorting task."""
    return with_dense_index(df, order, "_place").filter(F.col("_place") < budget).drop("_place")
