from datetime import datetime

from pyspark.sql import functions as F

from rankloom.functions import urls
from rankloom.operators.html import MAX_DEPTH, Selectors, extract_pieces, page_nodes
from rankloom.operators.pages import last_modified, normalised_links, web_pages
from rankloom.operators.robots import robots_gate, robots_rules

PAGE = """<html><body><h1 id="firstHeading">A <i>title</i> </h1>
<div id="mw-content-text"><div class="x mw-parser-output"><p> First<sup class="reference">[1]</sup> &amp; more
line </p><table><tr><td>gone</td></tr></table><h2>Empty</h2><h2>Kept<span class="mw-editsection">edit</span></h2>
<p>Second <a href="/wiki/Some_Page#part">x</a> <a href="https://en.wikipedia.org/wiki/Caf%C3%A9?q=1">y</a>
<a href="/wiki/Help:Me">h</a> <a href="/wiki/Some_Page">again</a> <a href="mailto:a@b.c">m</a> <a>none</a>
<p>Third<br>part<p>  </p><div>gone too</div></div></div>
<div id="mw-normal-catlinks">Categories: <ul><li><a href="/c">One cat</a></li><li> Two </ul></div>
<ul><li id="footer-info-lastmod">This page was last edited on 18 January 2018, at 21:30.</li></ul></body></html>"""


def pieces(spark, html, selectors=Selectors(), url="https://en.wikipedia.org/wiki/A_title"):
    pages = spark.createDataFrame([(1, url, html)], "page_id bigint, url string, html string")
    return extract_pieces(pages, selectors).first()


def test_extract_page(spark):
    found = pieces(spark, PAGE)
    assert found.title == "A title"
    assert [b.strip() for b in found.blocks] == ["First & more\nline", "Kept", "Second x y\nh again m none", "Thirdpart", ""]
    assert found.categories == ["One cat", "Two"]
    assert found.links[:2] == ["https://en.wikipedia.org/wiki/Some_Page#part", "https://en.wikipedia.org/wiki/Caf%C3%A9?q=1"]
    assert "21:30" in found.footer and found.error is None


def test_all_children_are_blocks_but_what_is_removed(spark):
    html = """<article><h1>T</h1>loose text<h2>Bare</h2><table><tr><td>x</td></tr></table><h2>Next</h2><h3>Sub</h3>
        <ul><li>one<li>two <div>box <b>in</b></div></ul><blockquote>said<script>no()</script></blockquote>
        <section><h4>a</h4><h4>b</h4>body <a href="/kept">k</a><div><a href="/gone">g</a></div></section><script>own</script></article>"""
    found = pieces(spark, html, Selectors(title="h1", content="article", removed=("h1", "table", "div")))
    assert found.title == "T" and found.categories is None and found.footer is None
    assert [" ".join(b.split()) for b in found.blocks] == ["Next", "Sub", "onetwo", "said", "bbody k", "own"]
    assert found.links == ["https://en.wikipedia.org/kept"]
    inner = pieces(spark, html, Selectors(title="h1", content="article", blocks="li", removed=()))
    assert [" ".join(b.split()) for b in inner.blocks] == ["one", "two box in"]


def test_selectors_by_class_attribute_and_child(spark):
    html = """<div class='a big'><p id=p1 data-x=1>one</p><i><p data-x=2>two</p></i></div><div class=ab><p>three</p></div><p class="it's">four</p>"""
    for selector, texts in ((".a p", ["one", "two"]), (".a > p", ["one"]), ("[data-x]", ["one", "two"]), ("p[data-x=2]", ["two"]),
                            ("div p", ["one", "two", "three"]), ("#p1", ["one"]), ("*[class=ab] p", ["three"]), (".none", [])):
        found = pieces(spark, f"<main>{html}</main>", Selectors(content="main", blocks=selector, removed=()))
        assert found.blocks == texts, selector


def test_deep_markup_keeps_its_text(spark):
    html = "<main>" + "".join(f"<i>{k} " for k in range(3 * MAX_DEPTH)) + "</main>"
    pages = spark.createDataFrame([(1, "http://a/", html), (2, "http://a/", "")], "page_id bigint, url string, html string")
    nodes = {r.page_id: r.nodes for r in page_nodes(pages).collect()}
    assert max(len(n.path) for n in nodes[1]) <= MAX_DEPTH + 1 and len(nodes[2]) == 1
    assert pieces(spark, html, Selectors(content="main", removed=())).blocks[0].split() == [str(k) for k in range(3 * MAX_DEPTH)]


def test_web_pages(spark):
    rows = [(0, "https://en.wikipedia.org/wiki/A_title", PAGE), (1, "https://x.org/", "<h1 id=firstHeading>only"),
            (2, "https://x.org/2", PAGE.replace("<li>", "<b>"))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    row = web_pages(pages, F.lit("2020-01-01 00:00:00")).collect()
    assert [r.page_id for r in row] == [0]
    assert row[0].content == "First & more\nline\nKept\nSecond x y\nh again m none\nThirdpart"
    assert row[0].out_links == ["Some Page", "Café"]
    assert row[0].last_modify == datetime(2018, 1, 18, 21, 30)


def test_last_modified_fallback(spark):
    texts = ["edited on 2 March 2017, at 01:05.", "n/a", None, "edited on 99 March 2017, at 01:05."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", last_modified(F.col("t"), F.lit("2020-01-01 00:00:00")).alias("m")).orderBy("i").collect()
    fallback = datetime(2020, 1, 1)
    assert [r.m for r in got] == [datetime(2017, 3, 2, 1, 5), fallback, fallback, fallback]


def test_link_normalisation(spark):
    links = ["HTTP://user@en.wikipedia.org:80/wiki/A?x=1#f", "http://en.wikipedia.org/wiki/A?x=1", "http://other.org/wiki/A",
             "http://en.wikipedia.org/wiki/a b|c", "javascript:void(0)", "http://en.wikipedia.org/about"]
    pages = spark.createDataFrame([(0, links)], "page_id bigint, links array<string>")
    got = normalised_links(pages, "page_id", "^en.wikipedia.org$", "^/wiki/([^:]*)$")
    assert {r.url for r in got.collect()} == {
        "http://en.wikipedia.org/wiki/A?x=1", "http://en.wikipedia.org/wiki/a b|c"}


def test_page_urls(spark):
    row = spark.range(1).select(urls.page_url(F.lit("A b c")).alias("u")).first()
    assert row.u == "https://en.wikipedia.org/wiki/A_b_c"


ROBOTS = [
    "User-agent: *", "Disallow: /private", "Allow: /private/ok", "user-AGENT: other", "Disallow: /",
    "junk", "User-agent: site-* # ours", " disallow: /tmp%20x # note", "Disallow:", "Allow: /private", "Disallow: /a+b",
]


def test_robots(spark):
    lines = spark.createDataFrame([("h", n, t) for n, t in enumerate(ROBOTS)] + [("g", 0, "Disallow: /")],
                                  "host string, line_no bigint, line string")
    rules = robots_rules(lines, "site-crawler")
    assert sorted((r.ordinal, r.path_prefix, r.allow) for r in rules.collect()) == [
        (1, "/private", True), (2, "/private/ok", True), (7, "/tmp x", False), (10, "/a b", False)]
    shut = robots_rules(lines, "other")
    urls_ = ["http://h/x", "http://h/tmp%20x", "http://g/x", "http://h/private/1?q"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls_)], "page_id bigint, url string")
    gate = {r.page_id: r.allowed for r in robots_gate(pages, rules).collect()}
    assert gate == {0: True, 1: True, 2: True, 3: True}
    gate = {r.page_id: r.allowed for r in robots_gate(pages, shut).collect()}
    assert gate == {0: False, 1: False, 2: True, 3: False}


def test_first_matching_rule_decides(spark):
    rules = spark.createDataFrame([("h", 3, "/a", True), ("h", 1, "/a/b", False), ("h", 2, "", True)],
                                  "host string, ordinal bigint, path_prefix string, allow boolean")
    pages = spark.createDataFrame([(0, "http://h/a/b/c"), (1, "http://h/a/c")], "page_id bigint, url string")
    assert {r.page_id: r.allowed for r in robots_gate(pages, rules).collect()} == {0: False, 1: True}


def test_bad_pages_end_no_job(spark):
    rows = [(1, "http://a/b", None), (2, "http://a/b", "<![foo"), (3, "http://a/b", "<h1>x"), (4, None, "")]
    got = {r.page_id: r for r in extract_pieces(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[1].error == "no page" and got[3].error is None and len(got) == 4  # whether the second is an error is up to the parser
