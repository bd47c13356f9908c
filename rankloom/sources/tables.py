"""The page table: schema, scan, count, validation and creation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rankloom.functions.text import pipe_join, pipe_split
from pyspark.sql import functions as F

PAGE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("last_modify", T.TimestampNTZType()),
    T.StructField("out_links", T.ArrayType(T.StringType())),
])
TEXT_COLUMNS = ("title", "content", "categories", "lastModify", "outLinks")
STAMP = "yyyy-MM-dd HH:mm"


class MissingTable(ValueError):
    pass


def scan_pages(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read only the named columns of a Parquet page table."""
    return checked(spark.read.parquet(path), columns).select(*columns)


def read_pages_jdbc(spark: SparkSession, url: str, table: str, split_column: str, bounds: tuple[int, int],
                    partitions: int, **options: str) -> DataFrame:
    """Read an external page table in parallel slices of a numeric column, pipe-joined text decoded."""
    lower, upper = bounds
    raw = spark.read.jdbc(url, table, column=split_column, lowerBound=lower, upperBound=upper,
                          numPartitions=partitions, properties=options)
    return from_text_columns(raw)


def checked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingTable(f"page table lacks {', '.join(missing)}")
    return df


def open_table(spark: SparkSession, name: str, columns: Sequence[str] = tuple(PAGE_SCHEMA.names)) -> DataFrame:
    """Catalog table, or MissingTable when it does not exist or lacks columns."""
    if not spark.catalog.tableExists(name):
        raise MissingTable(f"no table {name}")
    return checked(spark.table(name), columns)


def create_page_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Create the page table unless it is there."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PAGE_SCHEMA.fields)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{location}")


def page_count(pages: DataFrame) -> DataFrame:
    """(n_pages, is_empty): an empty corpus is where jobs stop."""
    return pages.agg(F.count("*").alias("n_pages")).withColumn("is_empty", F.col("n_pages") == 0)


def to_text_columns(pages: DataFrame) -> DataFrame:
    """Arrays as pipe-joined text, time as text: the all-text shape of the table."""
    return pages.select("title", "content", pipe_join(F.col("categories")).alias("categories"),
                        F.date_format("last_modify", STAMP).alias("lastModify"),
                        pipe_join(F.col("out_links")).alias("outLinks"))


def from_text_columns(rows: DataFrame) -> DataFrame:
    return checked(rows, TEXT_COLUMNS).select(
        "title", "content", pipe_split(F.col("categories")).alias("categories"),
        F.try_to_timestamp("lastModify", F.lit(STAMP)).cast("timestamp_ntz").alias("last_modify"),
        pipe_split(F.col("outLinks")).alias("out_links"),
    )
