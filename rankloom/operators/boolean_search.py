"""Secondary ranked search: boosted phrase, all-terms and any-term clauses per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import scoring as sc
from rankloom.operators.search import IndexTables, term_hits, weighted_slots


def phrase_starts(entries: Column) -> Column:
    """Positions where all slots follow one another; entries are (slot, positions) in slot order."""
    def start_positions(entry: Column) -> Column:
        return F.transform(entry["positions"], lambda p: p - entry["slot"])

    return F.reduce(
        F.slice(entries, F.lit(2), F.size(entries)), start_positions(entries[0]),
        lambda starts, entry: F.array_intersect(starts, start_positions(entry)),
    )


def clause_matches(index: IndexTables, slots: DataFrame,
                   params: sc.BooleanParams = sc.BooleanParams()) -> DataFrame:
    """Per (query, clause, field, document): matched words, their score sum and the phrase frequency."""
    hits = term_hits(index, weighted_slots(slots, index))
    idf = sc.bm25_idf(F.col("df"), F.col("n_docs"))
    saturation = sc.bm25_saturation(F.col("tf"), F.col("doc_len"), F.col("avg_len"), params)
    scored = hits.withColumn("idf", idf).withColumn("score", idf * saturation)
    grouped = scored.repartition("query_id", "doc_id").groupBy(
        "query_id", "doc_id", "clause", "field_id", "n_terms", "needs_category", "doc_len", "avg_len"
    ).agg(
        F.count("*").alias("n_matched"), F.sum("score").alias("terms_score"), F.sum("idf").alias("phrase_idf"),
        F.array_sort(F.collect_list(F.struct("slot", "positions"))).alias("entries"),
    )
    whole = F.col("n_matched") == F.col("n_terms")
    frequency = F.when(whole, F.size(phrase_starts(F.col("entries")))).otherwise(0)
    return grouped.withColumn("phrase_tf", frequency).drop("entries")


def clause_scores(matched: DataFrame, params: sc.BooleanParams = sc.BooleanParams()) -> DataFrame:
    """Add the three clause scores and their weighted sum ``score``."""
    def constant(name: str) -> Column:
        return sc.per_field(F.col("field_id"), {n: getattr(b, name) for n, b in params.boosts.items()})

    phrase = F.col("phrase_idf") * sc.bm25_saturation(
        F.col("phrase_tf"), F.col("doc_len"), F.col("avg_len"), params)
    has_phrase, whole = F.col("phrase_tf") > 0, F.col("n_matched") == F.col("n_terms")
    clauses = matched.withColumns({
        "phrase_clause": F.when(has_phrase, phrase * constant("phrase")).otherwise(0.0),
        "all_clause": F.when(whole, F.col("terms_score") * constant("all_terms")).otherwise(0.0),
        "any_clause": F.when(~has_phrase, F.col("terms_score") * constant("any_term")).otherwise(0.0),
    })
    total = F.col("phrase_clause") + F.col("all_clause") + F.col("any_clause")
    return clauses.withColumn("score", total * constant("field"))
