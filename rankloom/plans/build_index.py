"""Page table to serving tables, written once and searched many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators import postings as po
from rankloom.operators.dedupe import first_wins
from rankloom.operators.ids import with_dense_index
from rankloom.operators.links import adjacency, resolve_links
from rankloom.operators.pagerank import pagerank
from rankloom.operators.pages import complete_pages
from rankloom.operators.search import TERM_BUCKETS
from rankloom.session import materialise, temporary_tables
from rankloom.sources import serving

#: Characters of content, for each core, whose postings are shuffled at once.
PART_CHARS = 2**24


def numbered_documents(pages: DataFrame, arrival: str | None = None) -> DataFrame:
    """Complete pages, the first of each title, with dense ids in title order.

    An incomplete page doesn't take the place of a complete one that arrives later. Without ``arrival`` titles
    must be distinct already.
    """
    kept = complete_pages(pages).filter(F.col("title") != "")
    if not arrival:
        return with_dense_index(kept, ["title"], "doc_id")
    # Titles alone are sorted and written; pages meet their numbers where the first of each title is chosen, so they are shuffled once.
    numbers = with_dense_index(kept.select("title").distinct(), ["title"], "doc_id")
    return first_wins(kept, ["title"], [arrival]).join(numbers, "title").select(*pages.columns, "doc_id")


def document_links(docs: DataFrame) -> DataFrame:
    """(src, dst, pos) between documents."""
    return resolve_links(docs, docs)


def _publish_analyzer(docs: DataFrame, posted: Callable[[DataFrame], DataFrame], stats: DataFrame | None, path: str, buckets: int) -> None:
    """Write the postings that ``posted`` makes of documents, and their statistics.

    Parts of the documents come one after another, so that the shuffles of their postings take no more room on a machine
    the larger the corpus is.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("content"))).first()[0] or 0
    parts = max(1, -(-chars // (PART_CHARS * spark.sparkContext.defaultParallelism)))
    for n in range(parts):
        part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == n) if parts > 1 else docs
        with temporary_tables(spark):
            serving.publish_postings(posted(part), f"{path}/postings", buckets, "append" if n else "overwrite")
    written = spark.read.parquet(f"{path}/postings")
    serving.publish_term_stats(po.term_stats(written), f"{path}/term_stats", buckets)
    serving.publish(stats if stats is not None else po.standard_field_stats(written), f"{path}/field_stats")


def publish_primary(docs: DataFrame, lengths: DataFrame, path: str, stem: bool, buckets: int) -> None:
    _publish_analyzer(docs, lambda part: po.postings(part, stem), po.field_stats(lengths), f"{path}/{serving.PRIMARY}", buckets)


def publish_standard(docs: DataFrame, path: str, buckets: int) -> None:
    _publish_analyzer(docs, po.standard_postings, None, f"{path}/{serving.STANDARD}", buckets)


def publish_ranks(docs: DataFrame, path: str, epsilon: float = 1e-6) -> None:
    """Write the adjacency of the documents and their ranks."""
    with temporary_tables(docs.sparkSession):
        links = materialise(document_links(docs), "links")
        serving.publish(adjacency(links), f"{path}/adjacency")
        serving.publish(pagerank(links.select("src", "dst"), epsilon=epsilon).ranks, f"{path}/page_rank")


def build_index(pages: DataFrame, path: str, arrival: str | None = None, stem: bool = True,
                primary: bool = True, standard: bool = True, ranks: bool = True, term_buckets: int = TERM_BUCKETS,
                rank_epsilon: float = 1e-6) -> serving.Index:
    """Write documents, lengths, statistics, postings and ranks under ``path``.

    ``term_buckets`` is the number of folders postings are spread over. A query opens the folders
    of its terms only, so it should grow with the corpus: a few GB per folder work well.
    """
    spark = pages.sparkSession
    serving.publish(spark.range(1).select(F.lit(term_buckets).alias("term_buckets")), f"{path}/layout")
    with temporary_tables(spark):
        docs = serving.publish(numbered_documents(pages, arrival), f"{path}/documents")
    lengths = serving.publish(po.doc_lengths(docs), f"{path}/doc_lengths")
    if primary:
        publish_primary(docs, lengths, path, stem, term_buckets)
    if standard:
        publish_standard(docs, path, term_buckets)
    if ranks:
        publish_ranks(docs, path, rank_epsilon)
    return serving.Index(spark, path)


def rebuild_index(pages: DataFrame, path: str, **options) -> serving.Index:
    """Build an index beside the ones published in ``path`` and switch to it last; options as in ``build_index``.

    While it is built, and if the build fails, ``current_index`` opens the one before.
    """
    folder = serving.publish_version(pages.sparkSession, path, lambda to: build_index(pages, to, **options))
    return serving.Index(pages.sparkSession, folder)


def current_index(spark: SparkSession, path: str) -> serving.Index:
    return serving.Index(spark, serving.current_version(spark, path))
