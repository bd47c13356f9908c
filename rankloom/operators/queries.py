"""Query analysis over a table of queries (query_id, raw)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as tx
from rankloom.functions.stemmer import stem

# Marker in front of the category part, and which fields a clause searches.
CATEGORY_MARK = "category:"
CLAUSE_FIELDS = {"keyword": (tx.TITLE, tx.CONTENT), "category": (tx.CATEGORIES,)}


def split_queries(queries: DataFrame) -> DataFrame:
    """Add ``keyword`` and ``category``: text before and after the first marker, lower-cased."""
    raw = F.col("raw")
    at = F.instr(raw, CATEGORY_MARK)
    before = tx.jvm_trim(F.substring(raw, F.lit(1), at - 1))
    after = tx.jvm_trim(F.substring(raw, at + len(CATEGORY_MARK), F.length(raw)))
    return queries.withColumns({
        "keyword": F.lower(F.when(at > 0, before).otherwise(raw)),
        "category": F.lower(F.when(at > 0, after).otherwise("")),
    })


def query_slots(split: DataFrame, stemmed: bool = False, stop_words: bool = True) -> DataFrame:
    """(query_id, clause, slot, term, qf, is_first, n_terms, n_distinct, needs_category) per query word.

    Slots number the kept words from 0; ``qf`` is how often the term occurs in its clause and
    ``is_first`` marks its first slot. ``needs_category`` tells whether the query has a category
    text, even one of stop words only.
    """
    def kept(column: str):
        words = tx.keyword_words(F.col(column))
        return F.filter(words, lambda w: ~tx.is_stop_word(w)) if stop_words else words

    clauses = F.explode(F.array(*[
        F.struct(F.lit(clause).alias("clause"), kept(clause).alias("words")) for clause in CLAUSE_FIELDS
    ])).alias("c")
    needs = (F.col("category") != "").alias("needs_category")
    by_clause = split.select("query_id", needs, clauses).select("query_id", "needs_category", "c.clause", "c.words")
    if stemmed:
        flat = by_clause.select("query_id", "needs_category", "clause", F.posexplode("words").alias("slot", "word"))
        flat = flat.withColumn("word", stem("word"))
        by_clause = flat.groupBy("query_id", "needs_category", "clause").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("slot", "word"))), lambda e: e["word"]).alias("words")
        )
    counted = by_clause.withColumn("n_distinct", F.size(F.array_distinct("words")))
    slots = counted.select("query_id", "needs_category", "clause", "words", "n_distinct",
                           F.posexplode("words").alias("slot", "term"))
    return slots.select(
        "query_id", "clause", "slot", "term",
        F.expr("size(filter(words, w -> w = term))").alias("qf"),
        (F.array_position("words", F.col("term")) == F.col("slot") + 1).alias("is_first"),
        F.size("words").alias("n_terms"), "n_distinct", "needs_category",
    )


def query_terms(split: DataFrame, stemmed: bool = False) -> DataFrame:
    """(query_id, clause, pos, term)."""
    return query_slots(split, stemmed).select("query_id", "clause", F.col("slot").alias("pos"), "term")


def query_tf(split: DataFrame, stemmed: bool = False) -> DataFrame:
    """(query_id, clause, term, qf)."""
    return query_slots(split, stemmed).filter("is_first").select("query_id", "clause", "term", "qf")


def fields_of_clauses(slots: DataFrame) -> DataFrame:
    """Repeat query words for every field their clause searches."""
    fields = F.lit(None).cast("array<int>")
    for clause, numbers in CLAUSE_FIELDS.items():
        fields = F.when(F.col("clause") == clause, F.array(*map(F.lit, numbers))).otherwise(fields)
    return slots.withColumn("field_id", F.explode(fields))
