"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions import highlight as hl
from rankloom.functions import scoring as sc
from rankloom.functions import text as tx
from rankloom.functions import urls
from rankloom.functions.json_pointer import json_pointer
from rankloom.operators import boolean_search as bs
from rankloom.operators import frontier as fr
from rankloom.operators import ids, links, pagerank as pr, postings as po, queries as qs
from rankloom.operators import requests as rq
from rankloom.operators import robots
from rankloom.operators import ranked_search as ranked
from rankloom.operators import search as se
from rankloom.operators import results as rs
from rankloom.operators.dedupe import first_wins, new_rows
from rankloom.operators.html import extract_pieces
from rankloom.operators.pages import complete_pages, last_modified, normalised_links
from rankloom.operators.vocabulary import grown_vocabulary, vocabulary, written_vocabulary
from rankloom.plans import views as v
from rankloom.plans.batch_search import answer, answer_requests
from rankloom.plans.build_index import document_links
from rankloom.session import materialise, scratch_path
from rankloom.sources import interchange, jsonl, serving, tables
from rankloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PRIMARY_ONLY = (serving.PRIMARY,)


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def _joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def _r(value: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, digits)


# --- sources and sinks -------------------------------------------------------------------------

@query
def page_scan(spark, sf):
    """A1, A2: only the wanted columns of the stored page table."""
    path = f"{v.index(spark, sf, analyzers=()).path}/documents"
    pages = tables.scan_pages(spark, path, ["doc_id", "title", "content", "categories"])
    return pages.select("doc_id", "title", F.length("content").cast("bigint").alias("content_chars"),
                        tx.pipe_join(F.col("categories")).alias("categories"))


@query
def page_count(spark, sf):
    """A3."""
    return tables.page_count(complete_pages(v.raw_pages(spark, sf)))


@query
def table_lifecycle(spark, sf):
    """A4, A5, D-3: create the table if absent, fill it through its all-text shape, open it checked."""
    path = scratch_path(spark, "page-table")
    name = "pages_" + path.rsplit("-", 1)[1]
    tables.create_page_table(spark, name, path)
    as_text = tables.to_text_columns(v.raw_pages(spark, sf))
    tables.from_text_columns(as_text).write.insertInto(name)
    stored = tables.open_table(spark, name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, the name goes
    return stored.groupBy("title").agg(
        F.count("*").alias("n"), F.sum(F.length("content")).alias("chars"), F.sum(F.size("out_links")).alias("links"),
        F.date_format(F.max("last_modify"), tables.STAMP).alias("latest"))


@query
def bad_line_quarantine(spark, sf):
    """JSON lines, those of German pages cut in half, blank lines in between."""
    path = scratch_path(spark, "json-lines")
    line = F.to_json(F.struct(F.col("arrival").alias("id"), "title", "content", "categories"))
    language = F.col("categories")[1]
    lines = v.raw_pages(spark, sf).select(
        F.when(language == "de", F.substring(line, F.lit(1), F.length(line) - 10)).when(language == "es", " ")
        .otherwise(line).alias("value"))
    lines.write.text(path)
    good, bad = jsonl.read_lines(spark, path, jsonl.DOCUMENTS)
    kept = good.select(F.lit("good").alias("status"), "id", "title", F.length("content").cast("bigint").alias("chars"))
    return kept.unionByName(bad.select(
        F.lit("bad").alias("status"), F.regexp_extract("value", r'^\{"id":([0-9]+)', 1).cast("bigint").alias("id"),
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("bigint").alias("chars")))


@query
def json_export_rows(spark, sf):
    """The three exports, read back."""
    docs, path = v.wiki_pages(spark, sf), scratch_path(spark, "export")
    jsonl.export_documents(docs, path)
    jsonl.export_titles(docs, path)
    jsonl.export_links(links.adjacency(document_links(docs)), path)
    documents, _ = jsonl.read_lines(spark, f"{path}/documents", jsonl.DOCUMENTS)
    titles, _ = jsonl.read_lines(spark, f"{path}/titles", jsonl.TITLES)
    adjacency, _ = jsonl.read_lines(spark, f"{path}/links", jsonl.LINKS)
    return (
        documents.join(titles.withColumnRenamed("title", "name"), "id").join(adjacency, "id", "left")
        .select("id", "title", "name", F.md5("content").alias("content_md5"),
                tx.pipe_join(F.col("categories")).alias("categories"),
                F.coalesce(_joined(F.col("links")), F.lit("")).alias("links"))
    )


def _postings(spark, sf) -> DataFrame:
    return v.index(spark, sf, analyzers=PRIMARY_ONLY).table("primary/postings").drop("bucket")


@query
def posting_text_export(spark, sf):
    """A8."""
    path = scratch_path(spark, "posting-text")
    interchange.posting_lines(_postings(spark, sf)).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def posting_text_roundtrip(spark, sf):
    """Exported, read back and cut into long form."""
    path = scratch_path(spark, "posting-text")
    interchange.posting_lines(_postings(spark, sf)).write.text(path)
    back = interchange.parse_posting_lines(spark.read.text(path).withColumnRenamed("value", "line"))
    return back.select("term", F.col("field_id").cast("int"), "doc_id", "tf", _joined(F.col("positions")).alias("positions"))


@query
def rank_text_import(spark, sf):
    """A10, A11, D-10: ranks before the first round as text, read back with their maximum."""
    graph, path = v.part_links(spark, sf), scratch_path(spark, "rank-text")
    listed = links.adjacency(graph.withColumn("pos", F.col("dst")))
    interchange.rank_lines(pr.initial_ranks(graph), listed).write.text(path)
    ranks = interchange.parse_rank_lines(spark.read.text(path).withColumnRenamed("value", "line"))
    top = pr.max_rank(ranks).select(_r("max_rank", 12)).scalar()
    return ranks.select("doc_id", _r("rank", 12).alias("rank"), top.alias("max_rank"))


@query
def serving_lookup(spark, sf):
    """Statistics of a set of terms from the published tables."""
    index = v.index(spark, sf, analyzers=PRIMARY_ONLY)
    keys = qs.query_terms(qs.split_queries(v.queries_table(spark))).select("term")
    keys = keys.withColumn("bucket", se.term_bucket(F.col("term"), index.search_tables().buckets))
    stats = index.table("primary/term_stats")
    return serving.lookup(stats, keys, "bucket", "term").select("term", "field_id", "df")


@query
def versioned_publish(spark, sf):
    """Statistics published beside an earlier version, read from the one switched to last."""
    stats, path = v.index(spark, sf, analyzers=PRIMARY_ONLY).table("primary/term_stats").drop("bucket"), scratch_path(spark, "versions")
    for part in (stats.filter("field_id = 0"), stats):
        serving.publish_version(spark, path, lambda to, part=part: serving.publish_term_stats(part, to))
    return spark.read.parquet(serving.current_version(spark, path)).select("term", "field_id", "df")


@query
def first_wins_dedupe(spark, sf):
    """One page per title, and whether it would be new to a table of the first source's pages."""
    arriving = v.raw_pages(spark, sf).select("arrival", "title", F.col("categories")[0].alias("source"))
    stored = first_wins(arriving.filter(F.col("source") == "src1"), ["title"], ["arrival"])
    fresh = new_rows(arriving, stored, ["title"], ["arrival"]).withColumn("is_new", F.lit(True))
    return stored.withColumn("is_new", F.lit(False)).unionByName(fresh)


# --- web pages ---------------------------------------------------------------------------------

@query
def html_extract(spark, sf):
    """B1, B2."""
    return v.html_pages(spark, sf).select(
        "page_id", "title", "content", tx.pipe_join(F.col("categories")).alias("categories"),
        F.date_format("last_modify", tables.STAMP).alias("last_modify"), tx.pipe_join(F.col("out_links")).alias("out_links"))


@query
def page_filter(spark, sf):
    """B3."""
    return complete_pages(v.raw_pages(spark, sf)).select("arrival", "title")


@query
def last_modified_parse(spark, sf):
    """B4."""
    stamp = last_modified(F.col("footer"), F.lit(v.INGEST_TS))
    return v.edited_lines(spark, sf).select("event_id", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("last_modify"))


@query
def url_normalise(spark, sf):
    """Links of the raw pages and the page addresses themselves."""
    raw = extract_pieces(v.table(spark, sf, "pages"), v.PAGE_SELECTORS)
    both = raw.select("page_id", F.concat(F.array("url"), "links").alias("links"))
    return normalised_links(both, "page_id", v.HOST_PATTERN, "^/.*")


@query
def link_titles(spark, sf):
    """Titles the pages link to."""
    return v.html_pages(spark, sf).select("page_id", F.explode("out_links").alias("title"))


@query
def frontier_bfs(spark, sf):
    """B7, B8."""
    graph = v.part_links(spark, sf)
    start = graph.agg(F.min("src").alias("node"))
    return fr.expand_frontier(graph, start, max_depth=10).select("node", F.col("depth").cast("int").alias("depth"))


@query
def visited_suppression(spark, sf):
    """Targets that are no sources."""
    graph = v.part_links(spark, sf)
    candidates = graph.select(F.col("dst").alias("node")).distinct()
    return fr.unseen(candidates, graph.select(F.col("src").alias("node")))


@query
def page_budget(spark, sf):
    """B9."""
    nodes = v.part_links(spark, sf).groupBy(F.col("dst").alias("node")).agg(F.count("*").cast("int").alias("depth"))
    return fr.page_budget(nodes, 1000)


@query
def robots_rules(spark, sf):
    """B10."""
    return robots.robots_rules(v.robots_lines(spark, sf), v.AGENT)


@query
def robots_gate(spark, sf):
    """B11."""
    rules = robots.robots_rules(v.robots_lines(spark, sf), v.AGENT)
    return robots.robots_gate(v.table(spark, sf, "pages").select("page_id", "url"), rules).select("page_id", "allowed")


@query
def page_urls(spark, sf):
    """B12."""
    return v.wiki_pages(spark, sf).select(
        "doc_id", urls.page_url(F.col("title")).alias("url"),
        F.array_join(urls.category_urls(F.col("categories")), " ").alias("category_urls"))


# --- text analysis -----------------------------------------------------------------------------

def _summary(words: DataFrame, name: str) -> DataFrame:
    return words.groupBy(F.col(name).alias("token"), "field_id").agg(
        F.count("*").alias("n"), F.sum("pos").alias("sum_pos"), F.sum("doc_len").alias("sum_len"))


@query
def tokens_positional(spark, sf):
    """C1."""
    return _summary(po.raw_tokens(v.wiki_pages(spark, sf)), "token")


@query
def tokens_clean(spark, sf):
    """C2."""
    return _summary(po.clean_words(v.wiki_pages(spark, sf), keep_stop_words=True), "term")


@query
def stopword_filter(spark, sf):
    """C3, C7."""
    return _summary(po.clean_words(v.wiki_pages(spark, sf)), "term")


@query
def vocabulary_stem(spark, sf):
    """C4."""
    return vocabulary(po.clean_words(v.wiki_pages(spark, sf)))


@query
def vocabulary_growth(spark, sf):
    """C4: words of all documents against a kept vocabulary of one source; only new ones are stemmed."""
    docs = v.wiki_pages(spark, sf)
    kept = written_vocabulary(po.clean_words(docs.filter(F.col("categories")[0] == "src1")))
    return grown_vocabulary(po.clean_words(docs), kept).select("token", "n_occ", "is_new")


@query
def split_query(spark, sf):
    """F1, over the conversation turns as queries."""
    raw = v.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
        F.concat("text", F.when(F.col("role") == "user", " category: Src1 ").otherwise("")).alias("raw"))
    return qs.split_queries(raw).select("query_id", "keyword", "category")


def _conversation_queries(spark, sf) -> DataFrame:
    return qs.split_queries(v.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("raw")))


@query
def query_terms(spark, sf):
    """C5, over the conversation turns as queries."""
    return qs.query_terms(_conversation_queries(spark, sf)).select(
        "query_id", "clause", F.col("pos").cast("int").alias("pos"), "term")


@query
def query_tf(spark, sf):
    """C6."""
    return qs.query_tf(_conversation_queries(spark, sf)).select(
        "query_id", "clause", "term", F.col("qf").cast("int").alias("qf"))


# --- statistics, ids, index --------------------------------------------------------------------

@query
def dense_ids(spark, sf):
    """D-1."""
    titles = first_wins(v.raw_pages(spark, sf).select("arrival", "title"), ["title"], ["arrival"])
    return ids.with_dense_index(titles, ["title"], "doc_id")


@query
def even_split(spark, sf):
    """D-11: orders over seven workers."""
    numbered = ids.with_dense_index(v.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], "i")
    rows = numbered.count()
    return ids.even_split(numbered, "i", rows, 7).groupBy("worker").agg(
        F.count("*").alias("n"), F.min("i").alias("first"), F.max("i").alias("last"))


@query
def link_resolution(spark, sf):
    """D-2."""
    return document_links(v.wiki_pages(spark, sf)).select("src", "dst")


@query
def adjacency(spark, sf):
    """D-2, A7."""
    listed = links.adjacency(document_links(v.wiki_pages(spark, sf)))
    return listed.select("id", _joined(F.col("links")).alias("links"))


@query
def pipe_arrays(spark, sf):
    """D-3: content lines through pipe-joined text and back."""
    lines = v.raw_pages(spark, sf).select("arrival", F.translate("content", "\n", "|").alias("joined"))
    parts = lines.withColumn("parts", tx.pipe_split(F.col("joined")))
    return parts.select("arrival", F.size("parts").cast("int").alias("n"), F.md5(tx.pipe_join(F.col("parts"))).alias("back_md5"))


@query
def doc_lengths(spark, sf):
    """D-6."""
    return po.doc_lengths(v.wiki_pages(spark, sf)).withColumn("len", F.col("len").cast("bigint"))


@query
def field_stats(spark, sf):
    """D-7, D-8."""
    stats = po.field_stats(po.doc_lengths(v.wiki_pages(spark, sf)))
    return stats.select("field_id", "total_len", "n_docs", _r("avg_len").alias("avg_len"))


def _plain(posted: DataFrame) -> DataFrame:
    return posted.select("term", "field_id", "doc_id", "tf", _joined(F.col("positions")).alias("positions"), "doc_len")


@query
def postings_plain(spark, sf):
    """D-4."""
    return _plain(po.postings(v.wiki_pages(spark, sf)))


@query
def postings_standard(spark, sf):
    """D-12."""
    return _plain(po.standard_postings(v.wiki_pages(spark, sf)))


@query
def posting_lists(spark, sf):
    """D-5, with lists cut every 100 documents."""
    listed = po.posting_lists(_postings(spark, sf), block_docs=100)
    return listed.select("term", F.col("block").cast("bigint").alias("block"), F.col("df").cast("bigint").alias("df"),
                         _joined(F.transform("entries", lambda e: e["doc_id"])).alias("docs"))


@query
def term_stats(spark, sf):
    """D-9."""
    return po.term_stats(po.postings(v.wiki_pages(spark, sf)))


# --- link ranking ------------------------------------------------------------------------------

def _ranks(result: DataFrame) -> DataFrame:
    return result.select("doc_id", _r("rank", 12).alias("rank"))


@query
def pagerank_init(spark, sf):
    """E1."""
    return _ranks(pr.initial_ranks(v.part_links(spark, sf)))


@query
def pagerank_step(spark, sf):
    """One round."""
    return _ranks(pr.pagerank(v.part_links(spark, sf), rounds=1).ranks)


@query
def pagerank_fixed(spark, sf):
    """E5 with a fixed number of rounds; hot sources split into slices of 20 edges."""
    return _ranks(pr.pagerank(v.part_links(spark, sf), rounds=3, edges_per_slice=20).ranks)


@query
def pagerank_converged(spark, sf):
    """E4, E5."""
    result = pr.pagerank(v.supplier_links(spark, sf))
    return _ranks(result.ranks).withColumn("rounds", F.lit(result.rounds))


@query
def pagerank_dangling(spark, sf):
    """Ranks of nodes that only receive, until no node moves."""
    graph = v.part_links(spark, sf)
    ranks = pr.pagerank(graph).ranks
    return _ranks(ranks.join(graph.select(F.col("src").alias("doc_id")), "doc_id", "left_anti"))


@query
def rank_max(spark, sf):
    """D-10, of converged ranks."""
    ranks = pr.pagerank(v.supplier_links(spark, sf)).ranks
    return pr.max_rank(ranks).select(_r("max_rank", 12).alias("max_rank"))


# --- primary search ----------------------------------------------------------------------------

def _split(spark) -> DataFrame:
    return qs.split_queries(v.queries_table(spark))


def _scored(spark, sf) -> DataFrame:
    return se.bm25_terms(v.index(spark, sf, analyzers=PRIMARY_ONLY).search_tables(), qs.query_slots(_split(spark)))


def _fields(spark, sf) -> DataFrame:
    return se.field_scores(se.match_fields(_scored(spark, sf)))


def _combined(spark, sf) -> DataFrame:
    return se.combine_fields(_fields(spark, sf))


@query
def posting_fetch(spark, sf):
    """postings of the query words."""
    tables_ = v.index(spark, sf, analyzers=PRIMARY_ONLY).search_tables()
    hits = se.term_hits(tables_, se.weighted_slots(qs.query_slots(_split(spark)), tables_))
    return hits.select("query_id", "clause", F.col("slot").cast("int").alias("slot"), "term", "field_id", "doc_id", "tf", "df")


@query
def bm25_terms(spark, sf):
    """F3, F4."""
    return _scored(spark, sf).filter("is_first").select("query_id", "clause", "term", "field_id", "doc_id", _r("score").alias("score"))


@query
def match_coverage(spark, sf):
    """F5, F6."""
    return se.match_fields(_scored(spark, sf)).select(
        "query_id", "clause", "field_id", "doc_id", F.col("n_matched").cast("int").alias("n_matched"),
        F.col("n_distinct").cast("int").alias("n_distinct"), _r("raw").alias("raw"),
        (F.col("n_matched") == F.col("n_distinct")).alias("all_terms"))


@query
def adjacency_match(spark, sf):
    """F7."""
    return se.match_fields(_scored(spark, sf)).filter(F.col("n_adjacent").isNotNull()).select(
        "query_id", "clause", "field_id", "doc_id", F.col("n_adjacent").cast("int").alias("n_adjacent"),
        F.col("n_terms").cast("int").alias("n_terms"))


@query
def field_score(spark, sf):
    """F8."""
    return _fields(spark, sf).select("query_id", "clause", "field_id", "doc_id", "match", _r("score").alias("score"))


@query
def combine_inner(spark, sf):
    """F9."""
    return _combined(spark, sf).select("query_id", "doc_id", _r("title").alias("title"), _r("content").alias("content"),
                                       _r("text").alias("text"))


@query
def combine_outer(spark, sf):
    """F10."""
    either = se.combine_fields(_fields(spark, sf), how="either")
    return either.select("query_id", "doc_id", _r("text").alias("text"))


@query
def category_search(spark, sf):
    """F11."""
    return _combined(spark, sf).filter(F.col("category").isNotNull()).select(
        "query_id", "doc_id", _r("category").alias("category_score"), _r("text").alias("text"))


def _search(spark, sf, with_rank: bool) -> tuple[DataFrame, DataFrame]:
    tables_ = v.index(spark, sf, with_rank=with_rank, analyzers=PRIMARY_ONLY).search_tables(with_rank=with_rank)
    return ranked.search(tables_, v.queries_table(spark), with_rank)


@query
def hits(spark, sf):
    """F12, F17."""
    return _search(spark, sf, False)[1]


@query
def minmax_norm(spark, sf):
    """F13."""
    combined = _combined(spark, sf)
    return se.normalise_text(combined, se.query_stats(combined)).select("query_id", "doc_id", _r("text").alias("text"))


@query
def rank_blend(spark, sf):
    """F14."""
    return _search(spark, sf, True)[0].select(
        "query_id", "doc_id", _r("total", 5).alias("total"), _r("text", 5).alias("text"), _r("rank", 5).alias("rank"))


@query
def topk(spark, sf):
    """the thousand best of every query."""
    return _search(spark, sf, False)[0].select("query_id", F.col("rn").cast("int").alias("rn"), "doc_id", _r("total").alias("total"))


@query
def score_text(spark, sf):
    """F16, to five digits as the last ones depend on the order of sums."""
    total = _combined(spark, sf).select("query_id", "doc_id", _r("text", 5).alias("text"))
    return total.select("query_id", "doc_id", sc.score_text(F.col("text")).alias("score"))


# --- secondary search --------------------------------------------------------------------------

def _clauses(spark, sf) -> DataFrame:
    slots = qs.query_slots(_split(spark), stop_words=False)
    return bs.clause_matches(v.index(spark, sf, analyzers=(serving.STANDARD,)).search_tables(serving.STANDARD), slots)


@query
def phrase_match(spark, sf):
    """G1."""
    return _clauses(spark, sf).filter(F.col("phrase_tf") > 0).select(
        "query_id", "clause", "field_id", "doc_id", F.col("phrase_tf").cast("int").alias("phrase_tf"))


@query
def clause_scores(spark, sf):
    """G2, G3, G4."""
    return bs.clause_scores(_clauses(spark, sf)).select(
        "query_id", "clause", "field_id", "doc_id", _r("phrase_clause").alias("phrase_clause"),
        _r("all_clause").alias("all_clause"), _r("any_clause").alias("any_clause"), _r("score").alias("score"))


@query
def boolean_rank(spark, sf):
    """G5."""
    found, n = ranked.boolean_search(v.index(spark, sf, analyzers=(serving.STANDARD,)).search_tables(serving.STANDARD), v.queries_table(spark))
    return found.join(n, "query_id").select("query_id", "doc_id", "hits", _r("total").alias("total"))


@query
def fragment_snippet(spark, sf):
    """G6, for every document under one query."""
    rows = v.wiki_pages(spark, sf).select(F.lit(1).alias("query_id"), "doc_id", F.lit("the la").alias("keyword"), "content")
    return rs.fragment_snippets(rows)


# --- result assembly ---------------------------------------------------------------------------

@query
def highlight(spark, sf):
    """H1, over all titles."""
    return v.wiki_pages(spark, sf).select(
        "doc_id", hl.highlight(F.col("title"), F.lit("the an s"), "span").alias("title"))


@query
def sentence_snippet(spark, sf):
    """H2, over all documents."""
    return v.wiki_pages(spark, sf).select(
        "doc_id", hl.sentence_snippet(F.col("content"), F.lit("the la")).alias("snippet"))


def _best(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Cut-off results with scores rounded for comparison, and hit counts."""
    combined = materialise(_combined(spark, sf), "scored")
    best = se.top_results(combined.withColumn("total", F.round("text", 9)), 1000)
    found = best.withColumn("score", F.format_string("%.4f", "total")).select("query_id", "rn", "doc_id", "score")
    return found, se.query_hits(se.query_stats(combined), _split(spark))


def _wanted(spark) -> DataFrame:
    return v.queries_table(spark).select("query_id", (F.col("query_id") - 3).cast("int").alias("page"))


@query
def paginate(spark, sf):
    """H4: pages before, inside and after the result."""
    best, found = _best(spark, sf)
    return rs.paginate(best, found, _wanted(spark)).select(
        "query_id", F.col("rn").cast("int").alias("rn"), "doc_id", "page_no", "total_pages")


def _rows(spark, sf) -> tuple[DataFrame, DataFrame]:
    best, found = _best(spark, sf)
    shown = rs.paginate(best, found, _wanted(spark))
    return rs.result_rows(shown, _split(spark), v.wiki_pages(spark, sf)), found


@query
def result_page(spark, sf):
    """H3."""
    return _rows(spark, sf)[0].select(
        "query_id", F.col("rn").cast("int").alias("rn"), "doc_id", "title", "raw_title", "snippet",
        tx.pipe_join(F.col("categories")).alias("categories"), tx.pipe_join(F.col("raw_categories")).alias("raw_categories"),
        "last_modify", "score")


@query
def response_json(spark, sf):
    """H5."""
    rows, found = _rows(spark, sf)
    return rs.responses(rows, found, _wanted(spark)).select("query_id", "response")


@query
def request_log(spark, sf):
    """H6."""
    return rq.parse_requests(v.request_log(spark, sf))


@query
def batch_search(spark, sf):
    """H7: fixed queries, first page, un-stemmed, ranked by text alone."""
    asked = v.queries_table(spark)
    first_pages = asked.select("query_id", F.lit(0).alias("page"))
    answers = answer(v.index(spark, sf, analyzers=PRIMARY_ONLY), asked, first_pages, rq.TEXT, stemmed=False)
    first = F.get_json_object("response", "$.pages[0].url")
    return answers.select(
        "query_id", F.get_json_object("response", "$.hits").cast("bigint").alias("hits"), first.alias("first_url"),
        F.get_json_object("response", "$.totalPages").cast("int").alias("total_pages"))


@query
def batch_search_requests(spark, sf):
    """H7: the whole request log through all three searches, un-stemmed."""
    return answer_requests(v.index(spark, sf, with_rank=True), v.request_log(spark, sf), stemmed=False)


@query
def batch_search_stemmed(spark, sf):
    """C4 in the index and in the queries."""
    asked = v.queries_table(spark)
    first_pages = asked.select("query_id", F.lit(0).alias("page"))
    return answer(v.index(spark, sf, stem=True), asked, first_pages, rq.TEXT, stemmed=True).select("query_id", "response")


# --- JSON columns and streams ------------------------------------------------------------------

@query
def json_pointer_columns(spark, sf):
    """I1."""
    props = F.col("props")
    return v.table(spark, sf, "events").select(
        "event_id", json_pointer(props, "/k").alias("k"), json_pointer(props, "#/k").alias("k_fragment"),
        json_pointer(props, "/k/0").alias("inside"), json_pointer(props, "/missing").alias("missing"),
        json_pointer(F.concat(F.lit('{"a/b":[1,'), props, F.lit("]}")), "/a~1b/1/k").alias("nested"))


@query
def stream_ingest(spark, sf):
    """Documents streamed in files; the first page of a title stays."""
    source, target, marks = (scratch_path(spark, n) for n in ("arriving", "ingested", "ingest-marks"))
    pages = v.raw_pages(spark, sf)
    # A second wave brings the same titles again, later: nothing may change.
    for wave in (pages, pages.withColumn("arrival", F.col("arrival") + 10**9)):
        wave.write.mode("append").parquet(source)
        ingest.ingest(ingest.page_stream(spark, source, pages.schema), target, marks, "arrival").awaitTermination()
    return spark.read.parquet(target).select("title", "arrival")


@query
def stream_progress(spark, sf):
    """Counters of every batch of a stream that brings the documents by language."""
    source, target, marks = (scratch_path(spark, n) for n in ("arriving", "ingested", "ingest-marks"))
    pages, language = v.raw_pages(spark, sf), F.col("categories")[1]
    wave = F.when(language == "en", 0).when(language == "de", 1).otherwise(2)
    for n in range(3):
        pages.filter(wave == n).write.mode("append").parquet(source)
        arriving = ingest.page_stream(spark, source, pages.schema, files_per_batch=1_000_000)
        ingest.ingest(arriving, target, marks, "arrival").awaitTermination()
    return ingest.progress(spark, target).select(ingest.BATCH, "n_arrived", "n_inserted", "n_total")
