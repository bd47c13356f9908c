"""Relevance formulas and their parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.text import CATEGORIES, CONTENT, TITLE


@dataclass(frozen=True)
class Boosts:
    exact: float
    order: float
    all_terms: float
    partial: float
    field: float


# Content boosts are 32-bit constants, widened to 64 bits.
ORDER_CONTENT = 1.2000000476837158
ALL_TERMS_CONTENT = 1.0499999523162842


@dataclass(frozen=True)
class SearchParams:
    """Fixed values of the primary search."""

    k1: float = 1.2
    k2: float = 100.0
    b: float = 0.75
    boosts: dict[int, Boosts] = field(
        default_factory=lambda: {
            TITLE: Boosts(20.0, 10.0, 5.0, 1.0, 1.0),
            CONTENT: Boosts(2.0, ORDER_CONTENT, ALL_TERMS_CONTENT, 1.0, 0.5),
            CATEGORIES: Boosts(20.0, 10.0, 5.0, 1.0, 1.0),
        }
    )
    text_weight: float = 0.9
    rank_weight: float = 0.1
    text_scale: float = 100.0
    rank_scale: float = 1000.0
    top_k: int = 1000
    page_size: int = 10


@dataclass(frozen=True)
class ClauseBoosts:
    phrase: float
    all_terms: float
    any_term: float
    field: float


@dataclass(frozen=True)
class BooleanParams:
    """Fixed values of the secondary search."""

    k1: float = 1.2
    b: float = 0.75
    boosts: dict[int, ClauseBoosts] = field(
        default_factory=lambda: {
            TITLE: ClauseBoosts(20.0, 5.0, 1.0, 1.0),
            CONTENT: ClauseBoosts(2.0, ALL_TERMS_CONTENT, 1.0, 0.5),
            CATEGORIES: ClauseBoosts(20.0, 5.0, 1.0, 1.0),
        }
    )
    top_k: int = 1000
    page_size: int = 10


def bm25_tf_log(tf: Column, doc_len: Column, avg_len: Column, params: SearchParams) -> Column:
    """The part of the score that depends on the document."""
    norm = params.k1 * ((1 - params.b) + params.b * doc_len / avg_len)
    return F.log((params.k1 + 1) * tf / (norm + tf))


def bm25_query_log(qf: Column, df: Column, n_docs: Column, params: SearchParams) -> Column:
    """The part that depends on the query and the word alone."""
    return F.log((n_docs - df + 0.5) / (df + 0.5)) + F.log((params.k2 + 1) * qf / (params.k2 + qf))


def log_sum_bm25(tf: Column, qf: Column, df: Column, doc_len: Column, avg_len: Column, n_docs: Column,
                 params: SearchParams) -> Column:
    """Sum of three logarithms. It is negative for terms in over half of the documents."""
    return bm25_query_log(qf, df, n_docs, params) + bm25_tf_log(tf, doc_len, avg_len, params)


def bm25_idf(df: Column, n_docs: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_saturation(tf: Column, doc_len: Column, avg_len: Column, params: BooleanParams) -> Column:
    k1, b = params.k1, params.b
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * doc_len / avg_len))


def min_max(value: Column, low: Column, high: Column, scale: float) -> Column:
    """Map [low, high] onto [0, scale]; a single-point range maps to its top."""
    return F.when(low == high, F.lit(scale)).otherwise((value - low) / F.nullif(high - low, F.lit(0.0)) * scale)


def per_field(field_id: Column, values: dict[int, float]) -> Column:
    """Constant chosen by field number."""
    chosen = F.lit(None).cast("double")
    for number, value in values.items():
        chosen = F.when(field_id == number, F.lit(value)).otherwise(chosen)
    return chosen


def score_text(total: Column, text: Column | None = None, rank: Column | None = None) -> Column:
    if text is None or rank is None:
        return F.format_string("%.8f", total)
    return F.format_string(
        "%.8f (Normalized BM25 + Proximity: %.8f, Normalized PageRank: %.8f)", total, text, rank
    )
