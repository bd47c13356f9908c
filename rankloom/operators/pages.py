"""From extracted pieces to page rows: clean-up, rejection, dates and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import urls
from rankloom.functions.text import jvm_trim
from rankloom.operators.html import Selectors, extract_pieces

# Last-modified footer, its date pattern, and which links lead to pages.
EDITED = r"edited on ([^,]*), at ([^.]*)"
EDITED_FORMAT = "d MMMM yyyy HH:mm"
HOST_PATTERN = "^en.wikipedia.org$"
PATH_PATTERN = "^/wiki/([^:]*)$"


def joined_blocks(blocks: Column) -> Column:
    """Trimmed texts of the blocks that have any, one per line."""
    trimmed = F.transform(blocks, jvm_trim)
    return F.array_join(F.filter(trimmed, lambda block: block != ""), "\n")


def last_modified(footer: Column, fallback: Column) -> Column:
    """Timestamp in the footer text, or the fallback the caller passes in."""
    stamp = F.concat_ws(" ", F.regexp_extract(footer, EDITED, 1), F.regexp_extract(footer, EDITED, 2))
    parsed = F.try_to_timestamp(stamp, F.lit(EDITED_FORMAT)).cast("timestamp_ntz")
    return F.coalesce(parsed, fallback.cast("timestamp_ntz"))


def is_complete(title: Column, content: Column, categories: Column) -> Column:
    return title.isNotNull() & (F.length(content) > 0) & (F.size(categories) > 0)


def complete_pages(pages: DataFrame) -> DataFrame:
    """Pages with a title, some content and at least one category."""
    return pages.filter(is_complete(F.col("title"), F.col("content"), F.col("categories")))


def normalised_links(pages: DataFrame, key: str, host_pattern: str, path_pattern: str) -> DataFrame:
    """(key, url): distinct links to crawlable pages, without fragments."""
    link = F.col("link")
    return (
        pages.select(key, F.explode("links").alias("link"))
        .filter(urls.is_crawlable(link, host_pattern, path_pattern))
        .select(key, urls.without_fragment(link).alias("url")).distinct()
    )


def out_titles(links: Column, host_pattern: str, path_pattern: str) -> Column:
    """Distinct titles a page links to, in link order."""
    def title(link: Column) -> Column:
        return F.when(urls.is_crawlable(link, host_pattern, path_pattern), urls.link_title(link, path_pattern))

    return F.array_distinct(F.filter(F.transform(links, title), lambda t: t.isNotNull()))


def web_pages(pages: DataFrame, ingest_ts: Column, selectors: Selectors = Selectors(),
              host_pattern: str = HOST_PATTERN, path_pattern: str = PATH_PATTERN) -> DataFrame:
    """(page_id, url, title, content, categories, last_modify, out_links) of complete pages."""
    pieces = extract_pieces(pages, selectors)
    row = F.struct(
        "page_id", "url", jvm_trim(F.col("title")).alias("title"),
        joined_blocks(F.col("blocks")).alias("content"), "categories",
        last_modified(F.col("footer"), ingest_ts).alias("last_modify"),
        out_titles(F.col("links"), host_pattern, path_pattern).alias("out_links"),
    )
    # A row is made and judged in one place: a filter would be pushed below and make title, content and categories twice.
    return pieces.select(F.inline(F.filter(F.array(row), lambda page: is_complete(page["title"], page["content"], page["categories"]))))
