"""Incremental page ingest: a file stream of arriving pages into a page table, first title wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rankloom.operators.dedupe import new_rows
from rankloom.operators.pages import complete_pages
from rankloom.sources.serving import lookup

BATCH = "ingest_batch"
_COUNTERS = "n_arrived bigint, n_inserted bigint, n_total bigint"


def page_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 50,
                file_format: str = "parquet") -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .format(file_format).load(path)
    )


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(path)


def insert_batch(batch: DataFrame, batch_id: int, path: str, arrival: str) -> None:
    """Add the new titles of one micro-batch.

    A batch owns one folder of the table and compares itself with the folders of other batches
    only. A batch that runs again after a failure therefore replaces its own rows.
    """
    spark = batch.sparkSession
    n_arrived = batch.count()
    batch = complete_pages(batch).persist()
    stored = _stored(spark, path, batch.schema).filter(F.col(BATCH) != batch_id).select("title")
    # A batch is small next to the table: look its titles up there, so the table is not shuffled.
    known = lookup(stored, batch, "title")
    new_rows(batch, known, ["title"], [arrival]).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    batch.unpersist()
    n_inserted = spark.read.schema(batch.schema).parquet(f"{path}/{BATCH}={batch_id}").count()
    # An empty folder of its own makes the counters readable for the first batch.
    spark.createDataFrame([], _COUNTERS).write.mode("ignore").parquet(f"{counters_path(path)}/{BATCH}=-1")
    # Batches run one after another, so the total up to the one before is known; no row is added up twice.
    before = progress(spark, path).filter(F.col(BATCH) < batch_id).agg(F.max(F.struct(BATCH, "n_total")).alias("last")).first().last
    total = (before.n_total if before else 0) + n_inserted
    spark.createDataFrame([(n_arrived, n_inserted, total)], _COUNTERS).coalesce(1).write.mode("overwrite").parquet(
        f"{counters_path(path)}/{BATCH}={batch_id}")


def ingest(pages: DataFrame, path: str, checkpoint: str, arrival: str,
           prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start the stream over all files present; ``prepare`` turns raw input into page rows."""
    rows = prepare(pages) if prepare else pages
    # An empty folder of its own makes the table readable for the first batch.
    pages.sparkSession.createDataFrame([], rows.schema).write.mode("append").parquet(f"{path}/{BATCH}=-1")
    return (
        rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: insert_batch(batch, batch_id, path, arrival)).start()
    )


def counters_path(path: str) -> str:
    return f"{path.rstrip('/')}-counters"


def progress(spark: SparkSession, path: str) -> DataFrame:
    """(ingest_batch, n_arrived, n_inserted, n_total) of every batch so far, however many there were.

    Each batch writes its own counters, so one that runs again replaces them.
    """
    return spark.read.schema(f"{_COUNTERS}, {BATCH} bigint").parquet(counters_path(path))
