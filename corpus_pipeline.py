"""Pipeline over documents: quality, repeated lines, near-duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and is written and read again before the
next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import byte_bpe, decontaminate, line_dedup, rule_ensemble
from rankloom.llm.common import table
from rankloom.llm.queries import PATTERN, RANKS, near_duplicate_stage
from rankloom.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rule_ensemble.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_repeated_windows(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicate_stage(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(docs.select("doc_id", "text"), RANKS, PATTERN, with_offsets=False)
    return byte_bpe.digests(byte_bpe.decode(encoded.select("doc_id", "token_ids"), RANKS))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("tokens", tokens)]

#: The first and third stage can't be put in SQL: the one is a trained model, the other an iterated join.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
