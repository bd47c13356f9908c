import pytest
from pyspark.sql import functions as F

from conftest import RANKS
from rankloom.operators import postings as po
from rankloom.operators import queries as qs
from rankloom.functions.scoring import SearchParams
from rankloom.operators import block_search as blocks
from rankloom.operators import search as se
from rankloom.operators.block_search import BlockSearch, match_stats
from rankloom.operators.ranked_search import boolean_search, search
from rankloom.operators.pagerank import pagerank


def tables(docs, ranks=None):
    posted = po.postings(docs).cache()
    return se.IndexTables(posted, po.term_stats(posted), po.field_stats(po.doc_lengths(docs)), ranks)


@pytest.fixture(scope="module")
def index(docs):
    return tables(docs)


def run(spark, index, raws, **options):
    asked = spark.createDataFrame(list(enumerate(raws)), "query_id bigint, raw string")
    results, hits = search(index, asked, **options)
    rows = results.orderBy("query_id", "rn").collect()
    return rows, {r.query_id: r.hits for r in hits.collect()}


def totals(rows, query_id=0):
    return {r.doc_id: r.total for r in rows if r.query_id == query_id}


def test_known_scores(spark, index):
    rows, hits = run(spark, index, ["red fox"])
    expected = {0: 1.107232636, 1: 0.432194985, 3: -0.323075020, 6: -3.025898999}
    assert totals(rows) == pytest.approx(expected, abs=1e-8)
    assert [r.doc_id for r in rows] == [0, 1, 3, 6] and hits == {0: 4}
    assert rows[0].score == "1.10723264"


def test_field_classes(spark, index):
    asked = spark.createDataFrame([(0, "red fox")], "query_id bigint, raw string")
    slots = qs.query_slots(qs.split_queries(asked))
    scored = se.field_scores(se.match_fields(se.bm25_terms(index, slots)))
    classes = {(r.doc_id, r.field_id): r.match for r in scored.collect()}
    assert {d: classes[d, 0] for d in (0, 1, 3, 6)} == {0: "exact", 1: "all", 3: "partial", 6: "order"}
    assert {d: classes[d, 1] for d in (0, 1, 3, 6)} == {0: "order", 1: "all", 3: "partial", 6: "partial"}


def test_category_restriction(spark, index):
    rows, hits = run(spark, index, ["red fox category:wild animal"])
    expected = {0: 1.107232636, 1: 0.432194985, 3: -0.071760591, 6: -3.277213428}
    assert totals(rows) == pytest.approx(expected, abs=1e-8) and hits == {0: 4}


def test_queries_without_results(spark, index):
    rows, hits = run(spark, index, ["the of", "zzzz", "category:wild", "red category:the", "", "fox,"])
    assert rows == [] and set(hits.values()) == {0} and len(hits) == 6


def test_rank_blend(spark, docs, graph):
    blended = tables(docs, pagerank(graph).ranks)
    rows, _ = run(spark, blended, ["red fox", "tea"], with_rank=True)
    text = {0: 100.0, 1: 83.667646951, 3: 65.394093828, 6: 0.0}
    top = RANKS[2]
    expected = {d: t * 0.9 + RANKS.get(d, 1 / 7) / top * 1000 * 0.1 for d, t in text.items()}
    assert totals(rows) == pytest.approx(expected, abs=1e-5)
    assert [(r.doc_id, r.text) for r in rows if r.query_id == 1] == [(5, 100.0), (4, 100.0)]


def test_ties_by_document(spark, index):
    rows, _ = run(spark, index, ["tea"])
    assert [r.doc_id for r in rows] == [4, 5]
    assert totals(rows) == pytest.approx({4: 8.725093294, 5: 8.725093294}, abs=1e-8)


def test_batch_equals_single_queries(spark, index):
    raws = ["red fox", "tea", "red red fox", "hot tea category:drink", "zzzz", "fox red"]
    rows, hits = run(spark, index, raws)
    for i, raw in enumerate(raws):
        alone, alone_hits = run(spark, index, [raw])
        assert totals(alone) == totals(rows, i) and alone_hits[0] == hits[i]


def test_input_order_does_not_matter(spark, index, docs):
    shuffled = tables(docs.orderBy(F.rand(1)).repartition(5))
    assert totals(run(spark, shuffled, ["red fox"])[0]) == totals(run(spark, index, ["red fox"])[0])


def test_both_is_part_of_either(spark, index):
    asked = spark.createDataFrame([(0, "red fox bamboo")], "query_id bigint, raw string")
    split = qs.split_queries(asked)
    scored = se.field_scores(se.match_fields(se.bm25_terms(index, qs.query_slots(split))))
    both, either = (se.combine_fields(scored, how).select("doc_id", "text") for how in ("both", "either"))
    assert both.exceptAll(either).isEmpty() and either.count() >= both.count()


def test_repeated_terms_count_once_but_raise_qf(spark, index):
    asked = spark.createDataFrame([(0, "red fox red the")], "query_id bigint, raw string")
    slots = qs.query_slots(qs.split_queries(asked)).orderBy("slot").collect()
    assert [(s.slot, s.term, s.qf, s.is_first) for s in slots] == [
        (0, "red", 2, True), (1, "fox", 1, True), (2, "red", 2, False)]
    assert {(s.n_terms, s.n_distinct) for s in slots} == {(3, 2)}


def test_marker_is_case_sensitive(spark):
    raws = [(0, "A category: B "), (1, " A Category: B")]
    rows = qs.split_queries(spark.createDataFrame(raws, "query_id bigint, raw string")).orderBy("query_id").collect()
    assert [(r.keyword, r.category) for r in rows] == [("a", "b"), (" a category: b", "")]


def test_top_k_cut_keeps_hit_count(spark, index):
    from rankloom.functions.scoring import SearchParams
    rows, hits = run(spark, index, ["red fox"], params=SearchParams(top_k=2))
    assert [r.doc_id for r in rows] == [0, 1] and hits == {0: 4}


def test_boolean_search(spark, docs):
    posted = po.standard_postings(docs).cache()
    index = se.IndexTables(posted, po.term_stats(posted), po.standard_field_stats(posted))
    asked = spark.createDataFrame([(0, "red fox"), (1, "the red fox"), (2, "red fox category:wild")],
                                  "query_id bigint, raw string")
    results, hits = boolean_search(index, asked)
    rows = results.orderBy("query_id", "rn").collect()
    assert {r.query_id: r.hits for r in hits.collect()} == {0: 4, 1: 4, 2: 3}
    assert [r.doc_id for r in rows if r.query_id == 0][:2] == [0, 6]
    # A stop word is in no document: phrase and all-terms clauses cannot match, words still do.
    assert max(r.total for r in rows if r.query_id == 1) < max(r.total for r in rows if r.query_id == 0)


def test_blocks_agree_with_the_steps(spark, index):
    """Several blocks of few documents give the scores of the step-by-step operators, and hits and extremes that fit them."""
    raws = ["red fox", "tea", "red red fox cub", "hot tea category:drink", "zzzz", "blue whale category:sea animal"]
    split = qs.split_queries(spark.createDataFrame(list(enumerate(raws)), "query_id bigint, raw string"))
    slots = qs.query_slots(split)
    found = BlockSearch(index, slots, SearchParams(), block_docs=2).scores(None, 1000)
    steps = se.combine_fields(se.field_scores(se.match_fields(se.bm25_terms(index, slots))))
    want = {(r.query_id, r.doc_id): r.text for r in steps.collect()}
    got = {(r.query_id, r.doc_id): r.total for r in found.filter("doc_id is not null").collect()}
    assert want and got == pytest.approx(want, abs=1e-9)
    for r in match_stats(found).collect():
        own = [x for (q, _), x in want.items() if q == r.query_id]
        assert r.hits == len(own) and (r.low, r.high) == pytest.approx((min(own), max(own)), abs=1e-9)


def test_portions_of_queries_agree_with_all_at_once(spark, docs, graph, monkeypatch):
    raws = ["red fox", "tea", "red red fox cub", "hot tea category:drink", "zzzz", "fox red", ""]
    tables_ = tables(docs, pagerank(graph).ranks.cache())
    rows, hits = run(spark, tables_, raws, with_rank=True)
    monkeypatch.setattr(blocks, "PORTION_WORDS", 10)
    monkeypatch.setattr(blocks, "BROADCAST_WORDS", 0)
    monkeypatch.setattr(blocks.BlockSearch.__init__, "__defaults__", (2,))
    cut_rows, cut_hits = run(spark, tables_, raws, with_rank=True)
    assert [r[:3] for r in cut_rows] == [r[:3] for r in rows] and cut_hits == hits
    assert [r.total for r in cut_rows] == pytest.approx([r.total for r in rows], abs=1e-9)
    assert [r.score for r in cut_rows] == [r.score for r in rows]


def test_depth_cuts_what_blocks_give(spark, index):
    asked = spark.createDataFrame([(0, "red fox"), (1, "tea")], "query_id bigint, raw string")
    depths = spark.createDataFrame([(0, 2)], "query_id bigint, depth int")
    found = BlockSearch(index, qs.query_slots(qs.split_queries(asked)), SearchParams(), block_docs=2).scores(depths, 1000).collect()
    assert sorted((r.query_id, r.doc_id) for r in found if r.doc_id is not None) == [(0, 0), (0, 1), (1, 4), (1, 5)]
    assert {r.query_id: r.hits for r in found if r.doc_id is None} == {0: 4, 1: 2}


def test_queries_are_neither_shuffled_nor_paired_with_blocks(spark, index, monkeypatch):
    written = []
    keep = blocks.materialise
    monkeypatch.setattr(blocks, "materialise", lambda df, name, **more: written.append((name, df)) or keep(df, name, **more))
    run(spark, index, ["red fox", "tea"])
    plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in written}
    assert "query-blocks" not in plans and "words" not in plans["block-scores"]
    assert "MapInArrow" in plans["fetched-postings"] and "hashpartitioning(key" not in plans["fetched-postings"]
