import pytest
from pyspark.sql import functions as F

from conftest import RANKS
from rankloom.operators import frontier as fr
from rankloom.operators import links as li
from rankloom.operators import pagerank as pr


def ranks(result):
    return {r.doc_id: r.rank for r in result.ranks.collect()}


def test_rounds(graph):
    first = ranks(pr.pagerank(graph, rounds=1))
    assert first == pytest.approx({0: 0.25, 1: 0.14375, 2: 0.4625, 3: 0.0375, 4: 0.14375})
    second = ranks(pr.pagerank(graph, rounds=2))
    assert second == pytest.approx({0: 0.430625, 1: 0.14375, 2: 0.281875, 3: 0.0375, 4: 0.0534375})
    assert ranks(pr.pagerank(graph, rounds=0)) == {n: 0.25 for n in range(4)}


def test_convergence(graph):
    result = pr.pagerank(graph)
    assert (result.rounds, result.converged) == (26, True)
    assert ranks(result) == pytest.approx(RANKS, abs=1e-9)
    assert pr.max_rank(result.ranks).first().max_rank == pytest.approx(0.346099174, abs=1e-9)


def test_round_limit(graph):
    result = pr.pagerank(graph, max_rounds=3)
    assert (result.rounds, result.converged) == (3, False)


def test_slicing_a_hot_source_changes_nothing(spark):
    """One page holds a third of all links."""
    hot = [(0, t) for t in range(1, 101)]
    rest = [(s, (s * 7) % 101) for s in range(1, 101)] + [(s, (s * 3 + 1) % 101) for s in range(1, 101)]
    links = spark.createDataFrame(hot + rest, "src bigint, dst bigint")
    sliced = li.SlicedEdges.build(links, edges_per_slice=10)
    assert sliced.edges.filter("src = 0").select("slice").distinct().count() == 10
    whole, cut = ranks(pr.pagerank(links, rounds=5)), ranks(pr.pagerank(links, rounds=5, edges_per_slice=10))
    assert cut == pytest.approx(whole, abs=1e-12) and sum(whole.values()) == pytest.approx(1.0)


def test_link_resolution(spark):
    pages = spark.createDataFrame(
        [(0, "a", ["c", "x", "b"]), (1, "b", ["nowhere"]), (2, "c", [""])], "doc_id bigint, title string, out_links array<string>")
    links = li.resolve_links(pages, pages)
    assert li.adjacency(links).collect() == [(0, [2, 1])]


def test_frontier_against_brute_force(spark):
    edges = [(i, j % 40) for i in range(40) for j in (i * 2 + 1, i * 3) if j % 40 != i and i % 5]
    depth, frontier = {1: 0}, {1}
    for d in range(1, 4):
        frontier = {t for s, t in edges if s in frontier} - depth.keys()
        depth |= {t: d for t in frontier}
    links = spark.createDataFrame(edges, "src bigint, dst bigint")
    found = fr.expand_frontier(links, spark.createDataFrame([(1,)], "node bigint"), max_depth=3, edges_per_slice=1)
    assert {r.node: r.depth for r in found.collect()} == depth


def test_page_budget_ways_agree(spark):
    nodes = spark.range(300).select(F.col("id").alias("node"), (F.col("id") % 7).cast("int").alias("depth"))
    small, large = nodes.orderBy("depth", "node").limit(120), fr.page_budget(nodes, 120)
    assert sorted(small.collect()) == sorted(large.select(*small.columns).collect())


def test_few_edges_take_one_task(spark, monkeypatch):
    links = spark.createDataFrame([(i % 7, (3 * i + 1) % 11) for i in range(40)], "src bigint, dst bigint").distinct()
    few = li.SlicedEdges.build(links)
    assert few.edges.rdd.getNumPartitions() == 1
    whole = ranks(pr.pagerank(links))
    few.release()
    monkeypatch.setattr(li, "EDGES_PER_TASK", 5)
    many = li.SlicedEdges.build(links)
    assert many.tasks > 1
    many.release()
    dealt = ranks(pr.pagerank(links))
    assert dealt.keys() == whole.keys() and all(abs(dealt[n] - whole[n]) < 1e-12 for n in whole)
