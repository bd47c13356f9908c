"""Vocabulary job: stem every distinct word once and join the stems back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.stemmer import stem
from rankloom.session import materialise


def vocabulary(words: DataFrame, word: str = "term") -> DataFrame:
    """(token, n_occ, stem) from a table of word occurrences."""
    counted = words.groupBy(F.col(word).alias("token")).agg(F.count("*").alias("n_occ"))
    return counted.withColumn("stem", stem("token"))


def grown_vocabulary(words: DataFrame, stems: DataFrame, word: str = "term") -> DataFrame:
    """(token, n_occ, stem, is_new) of the words, where only those missing in ``stems`` (token, stem) are stemmed.

    Tokens of ``stems`` are distinct. Words are counted before they meet the stems, so the join sees each word once.
    """
    counted = materialise(words.groupBy(F.col(word).alias("token")).agg(F.count("*").alias("n_occ")), "words")
    known = counted.join(stems.select("token", "stem"), "token").select("token", "n_occ", "stem", F.lit(False).alias("is_new"))
    fresh = counted.join(stems.select("token"), "token", "left_anti")
    return known.unionByName(fresh.select("token", "n_occ", stem("token").alias("stem"), F.lit(True).alias("is_new")))


def with_stems(words: DataFrame, stems: DataFrame, word: str = "term") -> DataFrame:
    """Replace ``word`` by its stem.

    ``stems`` is a written vocabulary. The join has no hint: its measured bytes decide whether it is broadcast, and
    frequent words that crowd a shuffled partition are split at run time.
    """
    return words.join(stems.select(F.col("token").alias(word), "stem"), word).drop(word).withColumnRenamed("stem", word)


def written_vocabulary(words: DataFrame, word: str = "term") -> DataFrame:
    return materialise(vocabulary(words, word), "vocabulary")
