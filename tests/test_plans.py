"""Shapes of physical plans that must hold at scale."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from check import normal
from rankloom.operators import ids
from rankloom.operators import postings as po
from rankloom.operators import queries as qs
from rankloom.operators import search as se
from rankloom.operators.dedupe import first_wins
from rankloom.plans import views
from rankloom.plans.build_index import numbered_documents
from rankloom.sources.serving import publish_postings

SF = "/root/testdata/sf0.001"
ON_DEMAND = ("table_lifecycle", "json_export_rows", "posting_text_roundtrip", "robots_gate", "page_budget", "request_log",
             "clause_scores", "minmax_norm", "response_json", "html_extract", "sentence_snippet", "fragment_snippet")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_scan_is_pruned(spark):
    text = plan(views.raw_pages(spark, SF).select("arrival", "title"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_postings_shuffle_text_not_words(spark):
    pages = views.raw_pages(spark, SF).withColumnRenamed("arrival", "doc_id")
    text = plan(po.postings(pages))
    assert text.count("Exchange") == 1 and "hashpartitioning(doc_id" in text
    assert "Python" not in text and "Arrow" not in text


def test_search_has_one_shuffle_of_hits(spark, docs, tmp_path):
    publish_postings(po.postings(docs), str(tmp_path / "p"))
    posted = spark.read.parquet(str(tmp_path / "p"))
    stats = po.term_stats(posted).withColumn("bucket", se.term_bucket(F.col("term"))).cache()
    stats.count()
    fields = po.field_stats(po.doc_lengths(docs)).cache()
    fields.count()
    split = qs.split_queries(views.queries_table(spark))
    scored = se.field_scores(se.match_fields(se.bm25_terms(se.IndexTables(posted, stats, fields), qs.query_slots(split))))
    text = plan(se.combine_fields(scored))
    assert text.count("hashpartitioning(query_id") == 1
    assert "dynamicpruning" in text.lower()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text


def test_hot_groups_are_cut_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 2).alias("title"), F.col("id").alias("arrival"))
    assert plan(first_wins(rows, ["title"], ["arrival"])).count("WindowGroupLimit") == 2
    results = spark.range(5000).select((F.col("id") % 2).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") * 1.5).alias("total"))
    assert plan(se.top_results(results)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ON_DEMAND)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got, want = queries()[name](spark, SF).toPandas(), con.sql(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_postings_are_grouped_inside_the_document(spark):
    pages = views.raw_pages(spark, SF).withColumnRenamed("arrival", "doc_id")
    for made in (po.postings, po.standard_postings):
        text = plan(made(pages))
        assert "collect_list(pos" not in text and "Generate posexplode" not in text and text.count("Exchange") == 1


def test_rows_of_one_id_share_postings(spark):
    rows = [(None, "red fox", "a fox", ["x"]), (None, "fox tail", "red, fox", None), (7, "red", None, ["x", None])]
    docs = spark.createDataFrame(rows, "doc_id bigint, title string, content string, categories array<string>").repartition(3)
    got = {(r.term, r.field_id, r.doc_id): (r.tf, r.positions, r.doc_len) for r in po.postings(docs).collect()}
    assert got == {("fox", 0, None): (2, [0, 1], 2), ("red", 0, None): (1, [0], 2), ("tail", 0, None): (1, [1], 2), ("fox", 1, None): (2, [1, 1], 2),
                   ("red", 1, None): (1, [0], 2), ("x", 2, None): (1, [0], 1), ("red", 0, 7): (1, [0], 1), ("x", 2, 7): (1, [0], 1)}


def test_posting_lists_shuffle_postings_once(spark, docs, tmp_path):
    publish_postings(po.postings(docs), str(tmp_path / "p"))
    text = plan(po.posting_lists(spark.read.parquet(str(tmp_path / "p")), 3))
    assert text.count("Exchange") == 1 and "hashpartitioning(term" in text


def test_titles_alone_are_sorted_for_numbers(spark, monkeypatch):
    written = []
    monkeypatch.setattr(ids, "materialise", lambda df, name: written.append(df.columns) or df.cache())
    docs = numbered_documents(views.raw_pages(spark, SF), "arrival")
    assert written == [["title", "_mark"]] and docs.columns[-1] == "doc_id"
    rows = docs.select("doc_id", "title").orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(len(rows))) and [r.title for r in rows] == sorted(r.title for r in rows)


def test_stored_pages_need_no_postings(spark, monkeypatch):
    monkeypatch.setattr(views, "_built", {})
    views.wiki_pages(spark, SF)
    path = views.index(spark, SF, analyzers=()).path
    assert sorted(os.listdir(path)) == ["doc_lengths", "documents", "layout"]
    assert views.index(spark, SF, analyzers=("primary",)).path == path
    assert sorted(os.listdir(path)) == ["doc_lengths", "documents", "layout", "primary"]


def test_query_words_are_written_to_one_file(spark, docs):
    posted = po.postings(docs).cache()
    tables = se.IndexTables(posted, po.term_stats(posted), po.field_stats(po.doc_lengths(docs)))
    asked = spark.createDataFrame([(i, "red fox cub") for i in range(8)], "query_id bigint, raw string").repartition(8)
    assert len(se.weighted_slots(qs.query_slots(qs.split_queries(asked)), tables).inputFiles()) == 1
