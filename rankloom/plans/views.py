"""Corpus-shaped views over the test tables, and the index built from them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions import urls
from rankloom.operators.html import REMOVED, Selectors
from rankloom.operators.pages import web_pages
from rankloom.plans.build_index import build_index, publish_primary, publish_ranks, publish_standard
from rankloom.session import materialise, scratch_path
from rankloom.sources.serving import PRIMARY, STANDARD, Index

# Search words that occur in the documents, plus edge cases: category parts, only stop words, an
# unknown word, a category without keywords, a repeated word.
QUERIES = (
    (1, "thanea ther"), (2, "eriner attion"), (3, "anea category:src1 en"), (4, "the of"), (5, "zzzz"),
    (6, "category:src1"), (7, "thanea thanea ther"), (8, "la le"), (9, "On la"), (10, "la category:src2"),
)
# All children of the article are content but its title, which has its own column, tables and boxes.
PAGE_SELECTORS = Selectors(title="h1", content="article", category_box="nav", categories="li",
                           links="nav a[href]", links_anywhere=True, removed=("h1", *REMOVED))
HOST_PATTERN = r".*\.example\.(?:com|net|org)"
PATH_PATTERN = r"^/([^/:]*)$"
INGEST_TS = "2018-02-01 00:00:00"
AGENT = "site-crawler"

_built: dict[tuple[str, str], object] = {}


def _once(spark: SparkSession, name: str, sf: str, make):
    """Build a shared table once per Spark application and data folder."""
    key = (spark.sparkContext.applicationId, f"{name}:{sf}")
    if key not in _built:
        _built[key] = make()
    return _built[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def queries_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(QUERIES), "query_id bigint, raw string")


def raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as arriving pages: first line = title, rest = content, its lines = links."""
    text, newline = F.col("text"), "\n"
    rest = F.when(F.instr(text, newline) > 0, F.substring(text, F.instr(text, newline) + 1, F.length(text))).otherwise("")
    minutes = F.make_dt_interval(mins=F.pmod("doc_id", F.lit(1_000_000)).cast("int"))
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("arrival"), F.trim(F.split_part(text, F.lit(newline), F.lit(1))).alias("title"),
        rest.alias("content"), F.array("source", "lang").alias("categories"),
        (F.lit("2018-01-01 00:00:00").cast("timestamp_ntz") + minutes).alias("last_modify"),
    )
    lines = F.array_distinct(F.filter(F.transform(F.split("content", newline), F.trim), lambda line: line != ""))
    return rows.withColumn("out_links", lines)


def index(spark: SparkSession, sf: str, stem: bool = False, with_rank: bool = False,
          analyzers: Sequence[str] = (PRIMARY, STANDARD)) -> Index:
    """Serving tables of the document corpus; documents are built on first use, postings of an analyzer and ranks when first needed.

    A stemmed index has no standard analyzer.
    """
    built = _once(spark, f"index-{stem}", sf, lambda: build_index(
        raw_pages(spark, sf), scratch_path(spark, "index"), arrival="arrival", primary=False, standard=False, ranks=False))
    buckets = built.table("layout").first().term_buckets
    if PRIMARY in analyzers:
        _once(spark, f"primary-{stem}", sf, lambda: publish_primary(
            built.table("documents"), built.table("doc_lengths"), built.path, stem, buckets))
    if STANDARD in analyzers and not stem:
        _once(spark, "standard", sf, lambda: publish_standard(built.table("documents"), built.path, buckets))
    if with_rank:
        _once(spark, f"ranks-{stem}", sf, lambda: publish_ranks(built.table("documents"), built.path))
    return built


def wiki_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered documents of the index."""
    return index(spark, sf, analyzers=()).table("documents")


def part_links(spark: SparkSession, sf: str) -> DataFrame:
    """Part to order edges; ids share one space, orders beyond the part ids have no out-links."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("src"), F.col("l_orderkey").alias("dst")).distinct()


def supplier_links(spark: SparkSession, sf: str) -> DataFrame:
    """Part to supplier edges; ids share one space, all suppliers are also parts."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()


def html_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page rows extracted from the raw web pages."""
    def make() -> DataFrame:
        ts = F.lit(INGEST_TS).cast("timestamp_ntz")
        return materialise(web_pages(table(spark, sf, "pages"), ts, PAGE_SELECTORS, HOST_PATTERN, PATH_PATTERN), "pages")
    return _once(spark, "html", sf, make)


def robots_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Three robots.txt lines per web page: an agent, a disallowed and an allowed path."""
    url = F.col("url")
    language = F.regexp_extract(urls.path(url), "^/([a-z]+)/", 1)
    agent = (F.when(language == "fr", "*").when(language == "de", "other").when(language == "es", "SITE-*")
             .otherwise("site-*"))
    number = F.regexp_extract(urls.path(url), "^/[a-z]+/([0-9])", 1)
    texts = F.array(
        F.concat(F.lit("User-agent: "), agent, F.lit(" # page")),
        F.concat(F.lit(" disallow: /"), language, F.lit("/"), number),
        F.concat(F.lit("Allow: /"), language, F.lit("%2F"), F.length(url).cast("string")),
    )
    return table(spark, sf, "pages").select(
        urls.host(url).alias("host"), "page_id", F.posexplode(texts).alias("n", "line")
    ).select("host", (F.col("page_id") * 3 + F.col("n")).alias("line_no"), "line")


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """One search request per conversation turn, some of them faulty."""
    words = F.array_join(F.split(F.regexp_replace("text", r"[^\p{L}\p{N} ]+", ""), " "), "+")
    turn = F.col("turn")
    method = (F.when(turn % 4 == 0, "method=text&").when(turn % 4 == 1, "method=TextRank&")
              .when(turn % 4 == 2, "method=boolean&").otherwise(F.when(F.col("conv_id") % 2 == 0, "method=x&").otherwise("")))
    page = F.when(turn % 2 == 0, F.concat(F.lit("&page="), turn.cast("string"))).otherwise("&page=x&a=b=c")
    return table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + turn).alias("query_id"),
        F.concat(method, F.lit("keyword=%20"), words, page).alias("raw"))


def edited_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Last-modified footers written from event times; error events have none."""
    stamp = F.concat(F.lit("This page was last edited on "), F.date_format("ts", "d MMMM yyyy"), F.lit(", at "),
                     F.date_format("ts", "HH:mm"), F.lit("."))
    return table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "n/a").otherwise(stamp).alias("footer"))


def sql_pattern(pattern: str) -> str:
    """A pattern without the start and end marks, for whole-string matching elsewhere."""
    return re.sub(r"^\^|\$$", "", pattern)
