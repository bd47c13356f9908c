"""Running values along an ordered sequence, split so that long sequences use many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_last(df: DataFrame, key: str, position: str, value: Column, name: str, chunk: int = 4096) -> DataFrame:
    """Add the latest non-null ``value`` at or before each row of the sequence ``key``.

    Sequences are cut into chunks of ``chunk`` positions. Each chunk is reduced to its last
    value, the carry into a chunk comes from the far smaller table of chunks, and only then do
    rows meet a window, one chunk at a time.
    """
    df = df.withColumn("_chunk", F.floor(F.col(position) / chunk)).withColumn("_value", value)
    tails = df.groupBy(key, "_chunk").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(position))).alias("_tail")
    )
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carries = tails.select(key, "_chunk", F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
    inside = Window.partitionBy(key, "_chunk").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(carries, [key, "_chunk"])
        .withColumn(name, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_carry")))
        .drop("_chunk", "_value", "_carry")
    )
