"""Serving tables of a built index: publishing, loading and key lookups."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.search import TERM_BUCKETS, IndexTables, term_bucket
from rankloom.session import shuffles_dropped, writer, written

PRIMARY, STANDARD = "primary", "standard"
#: Compression of tables that are written once and stay.
LEVEL = 9


def publish_postings(posted: DataFrame, path: str, buckets: int = TERM_BUCKETS, mode: str = "overwrite") -> None:
    """Write postings into folders by term bucket, sorted by term.

    Joins on (bucket, term) skip the folders of other buckets (dynamic partition pruning), and
    row groups of other terms by their statistics. Tasks are cut by measured bytes: a bucket whose
    term is found in a large share of the documents is written by many of them, small buckets share
    one. Nothing is sampled, so the postings are computed once.
    """
    placed = posted.withColumn("bucket", term_bucket(F.col("term"), buckets))
    placed = placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "term", "field_id", "doc_id")
    with shuffles_dropped(posted.sparkSession):
        writer(placed, mode, LEVEL).partitionBy("bucket").parquet(path)


def publish_term_stats(stats: DataFrame, path: str, buckets: int = TERM_BUCKETS) -> None:
    placed = stats.withColumn("bucket", term_bucket(F.col("term"), buckets))
    placed = placed.repartition("bucket").sortWithinPartitions("bucket", "term")
    with shuffles_dropped(stats.sparkSession):
        writer(placed, "overwrite", LEVEL).partitionBy("bucket").parquet(path)


def publish(df: DataFrame, path: str) -> DataFrame:
    return written(df, path, "overwrite", LEVEL)


VERSIONS, PUBLISHED = "versions", "published"
_POINTER = "number bigint, folder string"


def publish_version(spark: SparkSession, path: str, write: Callable[[str], object]) -> str:
    """Fill a new folder below ``path`` by ``write``, then make it the current one; returns the folder.

    The folders published are rows of a table that only grows, and the row is added last: until then, and if ``write``
    fails, readers stay with the version before. Earlier versions are kept for readers that still have them open.
    """
    folder = f"{VERSIONS}/{uuid.uuid4().hex}"
    # An empty table makes the first look-up possible.
    spark.createDataFrame([], _POINTER).write.mode("ignore").parquet(f"{path}/{PUBLISHED}")
    write(f"{path}/{folder}")
    number = spark.read.schema(_POINTER).parquet(f"{path}/{PUBLISHED}").agg(F.coalesce(F.max("number"), F.lit(0)) + 1).first()[0]
    spark.createDataFrame([(number, folder)], _POINTER).coalesce(1).write.mode("append").parquet(f"{path}/{PUBLISHED}")
    return f"{path}/{folder}"


def current_version(spark: SparkSession, path: str) -> str:
    """Folder published last; of two that were published at once, the greater name."""
    newest = spark.read.schema(_POINTER).parquet(f"{path}/{PUBLISHED}").agg(F.max(F.struct("number", "folder")).alias("newest")).first().newest
    if newest is None:
        raise LookupError(f"nothing is published in {path}")
    return f"{path}/{newest.folder}"


@dataclass(frozen=True)
class Index:
    """Folder holding documents, doc_lengths, page_rank, layout, and postings with statistics per analyzer."""

    spark: SparkSession
    path: str
    opened: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def table(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self.opened[name]

    def search_tables(self, analyzer: str = PRIMARY, with_rank: bool = False) -> IndexTables:
        return IndexTables(
            self.table(f"{analyzer}/postings"), self.table(f"{analyzer}/term_stats"),
            self.table(f"{analyzer}/field_stats"), self.table("page_rank") if with_rank else None,
            self.table("layout").first().term_buckets,
        )


def lookup(table: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows of the given keys: one join for a whole set of keys."""
    return table.join(keys.select(*on).distinct(), list(on), "left_semi")
