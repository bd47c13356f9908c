"""Primary ranked search for a whole table of queries.

Postings meet the query words once; everything a document needs is then gathered in one shuffle
by (query, document). Groups are bounded by the query and the document, never by the term.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions import scoring as sc
from rankloom.functions.text import CATEGORIES, CONTENT, TITLE
from rankloom.operators.queries import fields_of_clauses
from rankloom.session import materialise


TERM_BUCKETS = 64


def term_bucket(term: Column, buckets: int = TERM_BUCKETS) -> Column:
    """Partition folder of a term in written postings."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class IndexTables:
    """Tables a search reads. ``postings`` may carry a ``bucket`` column of the term, out of ``buckets``."""

    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    ranks: DataFrame | None = None
    buckets: int = TERM_BUCKETS


def weighted_slots(slots: DataFrame, index: IndexTables) -> DataFrame:
    """Query words with document frequency and field statistics; words of no document drop out.

    Written before and after the look-up: the planner then knows how small the words are, sends
    them to the postings instead of shuffling postings, and opens only the folders they need. Rebalanced,
    as a file per task of a large index would make few words look like many.
    """
    keys = [c for c in ("bucket", "term", "field_id") if c in index.term_stats.columns]
    wanted = fields_of_clauses(slots)
    if "bucket" in keys:
        wanted = wanted.withColumn("bucket", term_bucket(F.col("term"), index.buckets))
    stats = index.field_stats.select("field_id", "avg_len", "n_docs")
    # Folders are pruned at run time only for a filtered side, hence the conditions that always hold.
    written = materialise(wanted.hint("rebalance"), "query-words").filter(F.col("qf") > 0)
    known = written.join(index.term_stats, keys).join(stats, "field_id")
    return materialise(known.hint("rebalance"), "query-words")


def term_hits(index: IndexTables, weighted: DataFrame) -> DataFrame:
    """Postings of the query words.

    No join hint: the small side is broadcast while Spark finds it below its threshold, and a
    larger query table falls back to a shuffled join whose frequent terms are split at run time.
    """
    keys = [c for c in ("bucket", "term", "field_id") if c in index.postings.columns and c in weighted.columns]
    postings = index.postings.filter(F.col("tf") > 0)
    return postings.join(weighted.filter(F.col("df") > 0), keys)


def bm25_terms(index: IndexTables, slots: DataFrame, params: sc.SearchParams = sc.SearchParams()) -> DataFrame:
    """One scored row per (query, clause, slot, field, document)."""
    hits = term_hits(index, weighted_slots(slots, index))
    # A field that is empty in every document has no average length and matches nothing.
    score = sc.log_sum_bm25(F.col("tf"), F.col("qf"), F.col("df"), F.col("doc_len"),
                            F.nullif(F.col("avg_len"), F.lit(0.0)), F.col("n_docs"), params)
    return hits.withColumn("score", score).filter(F.col("score").isNotNull())


def _adjacent_pairs(entries: Column) -> Column:
    """How many neighbouring slots have neighbouring positions; entries are in slot order."""
    def touches(left: Column, right: Column) -> Column:
        return F.arrays_overlap(F.transform(left["positions"], lambda p: p + 1), right["positions"])

    pairs = F.zip_with(
        F.slice(entries, F.lit(1), F.size(entries) - 1), F.slice(entries, F.lit(2), F.size(entries) - 1), touches
    )
    return F.size(F.filter(pairs, lambda hit: hit))


def match_fields(scored: DataFrame) -> DataFrame:
    """Per (query, clause, field, document): score sum, coverage and adjacency.

    Columns: raw, n_matched, n_distinct, n_terms, doc_len, n_adjacent (NULL unless all terms match).
    """
    positions = F.when(F.col("n_terms") > 1, F.struct("slot", "positions"))
    # (query, document) is the partitioning of this and of every later grouping of the search.
    grouped = scored.repartition("query_id", "doc_id").groupBy(
        "query_id", "doc_id", "clause", "field_id", "n_terms", "n_distinct", "needs_category", "doc_len"
    ).agg(
        F.sum(F.when(F.col("is_first"), F.col("score"))).alias("raw"),
        F.sum(F.col("is_first").cast("int")).alias("n_matched"),
        F.array_sort(F.collect_list(positions)).alias("entries"),
    )
    adjacent = F.when(
        F.col("n_matched") == F.col("n_distinct"),
        F.when(F.col("n_terms") == 1, F.lit(0)).otherwise(_adjacent_pairs(F.col("entries"))),
    )
    return grouped.withColumn("n_adjacent", adjacent).drop("entries")


def field_scores(matched: DataFrame, params: sc.SearchParams = sc.SearchParams()) -> DataFrame:
    """Add ``match`` (exact, order, all, partial) and the boosted ``score`` of the field."""
    match = (
        F.when(F.col("n_matched") < F.col("n_distinct"), "partial")
        .when(F.col("n_adjacent") < F.col("n_terms") - 1, "all")
        .when(F.col("doc_len") == F.col("n_terms"), "exact")
        .otherwise("order")
    )

    def constant(name: str) -> Column:
        return sc.per_field(F.col("field_id"), {n: getattr(b, name) for n, b in params.boosts.items()})

    boost = (
        F.when(F.col("match") == "exact", constant("exact")).when(F.col("match") == "order", constant("order"))
        .when(F.col("match") == "all", constant("all_terms")).otherwise(constant("partial"))
    )
    return matched.withColumn("match", match).withColumn("score", F.col("raw") * boost * constant("field"))


def combine_fields(scored: DataFrame, how: str = "both") -> DataFrame:
    """(query_id, doc_id, title, content, category, text): field scores side by side and summed.

    ``how="both"`` keeps documents matched in title and content, ``"either"`` in one of them.
    A query with a category text always needs the category field too.
    """
    def of_field(number: int) -> Column:
        return F.max(F.when(F.col("field_id") == number, F.col("score")))

    wide = scored.groupBy("query_id", "doc_id", "needs_category").agg(
        of_field(TITLE).alias("title"), of_field(CONTENT).alias("content"), of_field(CATEGORIES).alias("category")
    )
    title, content, category = F.col("title"), F.col("content"), F.col("category")
    found = title.isNotNull() & content.isNotNull() if how == "both" else title.isNotNull() | content.isNotNull()
    kept = wide.filter(found & (~F.col("needs_category") | category.isNotNull()))
    none = F.lit(0.0)
    total = F.coalesce(title, none) + F.coalesce(content, none) + F.coalesce(category, none)
    return kept.withColumn("text", total).drop("needs_category")


def query_stats(combined: DataFrame) -> DataFrame:
    """(query_id, hits, low, high) of the queries with results, before any cut-off."""
    return combined.groupBy("query_id").agg(
        F.count("*").alias("hits"), F.min("text").alias("low"), F.max("text").alias("high"))


def query_hits(stats: DataFrame, split: DataFrame) -> DataFrame:
    """(query_id, hits) of all queries, 0 for those without results."""
    return split.select("query_id").join(stats.select("query_id", "hits"), "query_id", "left").select(
        "query_id", F.coalesce("hits", F.lit(0)).alias("hits")
    )


def normalise_text(combined: DataFrame, stats: DataFrame, params: sc.SearchParams = sc.SearchParams()) -> DataFrame:
    """Stretch the text scores of every query over [0, 100].

    The extremes are aggregated and joined back: a window per query would put all documents of a
    query into one task.
    """
    stretched = sc.min_max(F.col("text"), F.col("low"), F.col("high"), params.text_scale)
    return combined.join(stats.select("query_id", "low", "high"), "query_id").withColumn(
        "text", stretched).drop("low", "high")


def blend_rank(normalised: DataFrame, ranks: DataFrame, n_docs: int, top_rank: float,
               params: sc.SearchParams = sc.SearchParams()) -> DataFrame:
    """Add the scaled ``rank`` and the weighted ``total``; unranked documents count as 1/n_docs."""
    own = F.coalesce(F.col("_rank"), F.lit(1.0 / n_docs))
    scaled = sc.min_max(own, F.lit(0.0), F.lit(top_rank), params.rank_scale)
    joined = normalised.join(ranks.select("doc_id", F.col("rank").alias("_rank")), "doc_id", "left")
    return joined.withColumn("rank", scaled).withColumn(
        "total", F.col("text") * params.text_weight + F.col("rank") * params.rank_weight
    ).drop("_rank")


def top_results(scored: DataFrame, k: int = 1000) -> DataFrame:
    """Add ``rn`` and keep the best k documents of every query, ties by document id.

    Every task first cuts a query to its own best k (WindowGroupLimit), so the final sort of a
    query sees at most k rows per task, however many documents match. That rewrite covers k up to
    spark.sql.optimizer.windowGroupLimitThreshold (1000).
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("total"), "doc_id")
    return scored.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k)


