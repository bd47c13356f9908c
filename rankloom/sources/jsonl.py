"""JSON-lines exchange: three exports and a reader that sets bad lines aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT, _ID = T.StringType(), T.LongType()
DOCUMENTS = T.StructType().add("id", _ID).add("title", _TEXT).add("content", _TEXT).add("categories", T.ArrayType(_TEXT))
TITLES = T.StructType().add("id", _ID).add("title", _TEXT)
LINKS = T.StructType().add("id", _ID).add("links", T.ArrayType(_ID))


def export_documents(docs: DataFrame, path: str) -> None:
    docs.select(F.col("doc_id").alias("id"), "title", "content", "categories").write.json(f"{path}/documents")


def export_titles(docs: DataFrame, path: str) -> None:
    docs.select(F.col("doc_id").alias("id"), "title").write.json(f"{path}/titles")


def export_links(adjacency: DataFrame, path: str) -> None:
    adjacency.select("id", "links").write.json(f"{path}/links")


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of lines that are no object or lack a field.

    Blank lines are neither. Lines are parsed by a column expression, so both results can be
    taken from one scan and pruned like any other read.
    """
    bad = "_bad"
    parsed = F.from_json("value", T.StructType([*schema.fields, T.StructField(bad, T.StringType())]),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    rows = spark.read.text(path).filter(F.trim("value") != "").select("value", parsed.alias("row"))
    complete = F.col("row").isNotNull() & F.col(f"row.{bad}").isNull()
    for name in schema.names:
        complete = complete & F.col(f"row.{name}").isNotNull()
    good = rows.filter(complete).select(*[F.col(f"row.{name}") for name in schema.names])
    return good, rows.filter(~F.coalesce(complete, F.lit(False))).select("value")
