"""Text interchange formats of postings and ranks.

Posting line: ``term TAB doc:f0,f1,f2|p,p,...;doc:...``. Rank line: ``doc,rank TAB target,target``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.operators.postings import BLOCK_DOCS, posting_lists


def _numbers(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def posting_lines(posted: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(line): documents of a term in id order, one line per block of the term's list."""
    def entry(e: Column) -> Column:
        return F.concat(e["doc_id"].cast("string"), F.lit(":"), _numbers(e["tf"]), F.lit("|"),
                        _numbers(F.flatten(e["positions"])))

    joined = F.array_join(F.transform("entries", entry), ";")
    return posting_lists(posted, block_docs).select(F.concat("term", F.lit("\t"), joined).alias("line"))


def parse_posting_lines(lines: DataFrame) -> DataFrame:
    """(term, field_id, doc_id, tf, positions) from posting lines; the inverse of ``posting_lines``.

    The flat position list is cut back into fields by the running sum of the frequencies.
    """
    parts = lines.select(F.split_part("line", F.lit("\t"), F.lit(1)).alias("term"),
                         F.split_part("line", F.lit("\t"), F.lit(2)).alias("list"))
    entries = parts.select("term", F.explode(F.split("list", ";")).alias("entry"))
    cut = entries.select(
        "term", F.split_part("entry", F.lit(":"), F.lit(1)).cast("bigint").alias("doc_id"),
        F.split_part("entry", F.lit(":"), F.lit(2)).alias("body"),
    ).select(
        "term", "doc_id", F.split(F.split_part("body", F.lit("|"), F.lit(1)), ",").cast("array<int>").alias("tf"),
        F.split(F.split_part("body", F.lit("|"), F.lit(2)), ",").cast("array<int>").alias("flat"),
    )
    fields = cut.select("term", "doc_id", "tf", "flat", F.posexplode("tf").alias("field_id", "n"))
    before = F.reduce(F.slice("tf", F.lit(1), F.col("field_id")), F.lit(0), lambda acc, n: acc + n)
    return fields.filter(F.col("n") > 0).select(
        "term", "field_id", "doc_id", F.col("n").alias("tf"), F.slice("flat", before + 1, F.col("n")).alias("positions")
    )


def rank_lines(ranks: DataFrame, adjacency: DataFrame) -> DataFrame:
    """(line) of every ranked document with its out-links."""
    return ranks.join(adjacency.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(","), F.col("rank").cast("string"), F.lit("\t"),
                 F.coalesce(_numbers(F.col("links")), F.lit(""))).alias("line"))


def parse_rank_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, rank) from the part in front of the tab."""
    key = F.split(F.split_part("line", F.lit("\t"), F.lit(1)), ",")
    return lines.select(F.get(key, F.lit(0)).cast("bigint").alias("doc_id"),
                        F.get(key, F.lit(1)).cast("double").alias("rank"))
