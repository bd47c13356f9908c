"""Field extraction from HTML pages.

A helper turns each page into flat rows in page order, one per element or text, with the standard library's tolerant
parser. Selection, removals, the heading rule and the texts are column expressions on those rows, which stay in the
page's own record: nothing is shuffled. Trimming, joining, filtering and link handling are in ``operators.pages``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements that never have a body.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Elements an open <p> ends at.
ENDS_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
    "section", "table", "ul",
}
# Default selectors of an encyclopedia page, and what its content drops.
REMOVED = ("sup[class=reference]", "span[class=mw-editsection]", "table", "div")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
SILENT = ("script", "style")

#: Elements nested deeper, as in broken markup only, become children of this depth, as browsers do; their text stays.
MAX_DEPTH = 512
#: Pages of an output batch.
BATCH_PAGES = 100

_STEP = re.compile(r"(?P<child>>?)\s*(?P<tag>[\w*-]*)(?P<rest>(?:[#.][\w-]+|\[[^\]]*\])*)")
_CONDITION = re.compile(r"([#.])([\w-]+)|\[([\w-]+)(?:=['\"]?([^'\"\]]*)['\"]?)?\]")


@dataclass(frozen=True)
class Selectors:
    """What to look for. With ``blocks`` empty the children of ``content`` are the blocks."""

    title: str = "#firstHeading"
    content: str = "#mw-content-text .mw-parser-output"
    blocks: str = ""
    category_box: str = "#mw-normal-catlinks"
    categories: str = "ul > li"
    footer: str = "#footer-info-lastmod"
    links: str = "a[href]"
    links_anywhere: bool = False
    removed: tuple[str, ...] = REMOVED


#: One element or text: its place, those of its parent, last descendant and ancestors, and what it holds.
NODE = pa.struct([
    ("n", pa.int32()), ("parent", pa.int32()), ("last", pa.int32()), ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("link", pa.string()), ("text", pa.string()), ("path", pa.list_(pa.int32())),
])
NODES = ("array<struct<n:int,parent:int,last:int,tag:string,attrs:map<string,string>,link:string,text:string,path:array<int>>>")


class _Flattener(HTMLParser):
    """Rows of a page in page order; ``open`` holds the places of the open elements, the page itself first."""

    def __init__(self, url: str) -> None:
        super().__init__(convert_charrefs=True)
        self.url = url
        self.rows: list[dict] = []
        self.open: list[int] = []
        self._add(tag="", attrs=[])
        self.open.append(0)

    def _add(self, tag=None, attrs=None, link=None, text=None) -> None:
        n = len(self.rows)
        parent = self.open[-1] if self.open else -1
        self.rows.append({"n": n, "parent": parent, "last": n, "tag": tag, "attrs": attrs, "link": link, "text": text,
                          "path": list(self.open)})

    def _pop(self) -> None:
        self.rows[self.open.pop()]["last"] = len(self.rows) - 1

    def _end(self, tag: str, barriers: frozenset = frozenset()) -> None:
        """End the nearest open element of that tag, unless a barrier comes first."""
        for depth in range(len(self.open) - 1, 0, -1):
            found = self.rows[self.open[depth]]["tag"]
            if found == tag:
                while len(self.open) > depth:
                    self._pop()
                return
            if found in barriers:
                return

    def _link(self, attrs: dict[str, str]) -> str | None:
        try:
            return urljoin(self.url, attrs["href"].strip()) if "href" in attrs else None
        except ValueError:
            return None

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._end("p", frozenset(("article", "div", "li", "td", "section", "body")))
        elif tag == "li":
            self._end("li", frozenset(("ul", "ol")))
        named = {k: v or "" for k, v in attrs}
        if len(self.open) > MAX_DEPTH:
            self._pop()
        self._add(tag=tag, attrs=list(named.items()), link=self._link(named))
        if tag not in VOID:
            self.open.append(len(self.rows) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop()

    def handle_endtag(self, tag):
        self._end(tag)

    def handle_data(self, data):
        self._add(text=data)

    def finish(self) -> list[dict]:
        self.close()
        while self.open:
            self._pop()
        return self.rows


def flat_page(html: str | None, url: str | None) -> tuple[list[dict] | None, str | None]:
    """Rows of a page, or nothing and the reason where it can't be read."""
    if html is None:
        return None, "no page"
    try:
        flattener = _Flattener(url or "")
        flattener.feed(html)
        return flattener.finish(), None
    except (AssertionError, ValueError, RecursionError) as error:  # broken markup ends the page, not the job
        return None, f"{type(error).__name__}: {error}"


def page_nodes(pages: DataFrame) -> DataFrame:
    """(page_id, url, nodes, error): the flat rows of every page, in page order."""
    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arriving:
            for start in range(0, batch.num_rows, BATCH_PAGES):
                part = batch.slice(start, BATCH_PAGES)
                read = [flat_page(h, u) for h, u in zip(part.column("html").to_pylist(), part.column("url").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array([rows for rows, _ in read], pa.list_(NODE)),
                     pa.array([error for _, error in read], pa.string())], ["page_id", "url", "nodes", "error"])

    kept = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return kept.mapInArrow(batches, f"page_id bigint, url string, nodes {NODES}, error string")


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is worked out once a row, also where a loop over nodes uses it."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _accepts(tag: str, conditions) -> str:
    """Test of the element ``node``."""
    fits = ["node.text IS NULL", "node.n > 0"]
    if tag not in ("", "*"):
        fits.append(f"node.tag = {_quoted(tag)}")
    for mark, name, attribute, value in conditions:
        held = f"node.attrs[{_quoted(attribute or {'#': 'id', '.': 'class'}[mark])}]"
        if mark == ".":
            fits.append(rf"array_contains(split({held}, '[ \\t\\n\\f\\r]+'), {_quoted(name)})")
        elif mark or value:
            fits.append(f"{held} = {_quoted(name or value)}")
        else:
            fits.append(f"{held} IS NOT NULL")
    return " AND ".join(fits)


def _steps(selector: str) -> list[re.Match]:
    return [step for step in _STEP.finditer(selector) if step.group(0).strip()]


def _under(step: re.Match, scope: str) -> str:
    """Test of the element ``node`` for the first step of a selector, below the place ``start``."""
    test = _accepts(step["tag"], _CONDITION.findall(step["rest"]))
    if step["child"]:
        return f"({test} AND node.parent = start)"
    return f"({test})" if scope == "0" else f"({test} AND array_contains(node.path, start))"


def _matches_any(selectors: list[list[re.Match]], scope: str) -> str:
    """For each node whether it matches one of the selectors of a single step, in one walk."""
    test = " OR ".join(_under(step, scope) for step, in selectors) or "false"
    return _bound(scope, "start", f"transform(nodes, node -> coalesce({test}, false))")


def matches(selector: str, scope: str = "0") -> str:
    """For each node whether it matches tag, #id, .class, [attribute=value], blank and > steps below ``scope``."""
    first, *later = _steps(selector)
    reached = _matches_any([[first]], scope)
    for step in later:
        above = "get(before, node.parent)" if step["child"] else "exists(node.path, place -> get(before, place))"
        test = f"{_accepts(step['tag'], _CONDITION.findall(step['rest']))} AND {above}"
        reached = _bound(reached, "before", f"transform(nodes, node -> coalesce({test}, false))")
    return reached


def _first(hits: str) -> str:
    """Place of the first match, null without one."""
    return f"nullif(cast(array_position({hits}, true) AS int), 0) - 1"


def _inherited(flags: str) -> str:
    """Flags of the nodes handed down to all below them."""
    return _bound(flags, "known", "transform(nodes, node -> get(known, node.n) OR exists(node.path, place -> get(known, place)))")


def _among(hits: str) -> str:
    return _bound(hits, "known", "filter(nodes, node -> get(known, node.n))")


def _left(found: str) -> str:
    return _bound("dropped", "gone", f"filter({found}, node -> NOT get(gone, node.n))")


def _texts(chosen: str, dropped: str) -> str:
    """Texts below the chosen nodes, each in page order, without scripts, styles and what is dropped."""
    silent = f"get(nodes, part.parent).tag IN ({', '.join(map(_quoted, SILENT))}) AND part.parent <> top.n"
    heard = f"part.text IS NOT NULL AND NOT ({silent}) AND NOT get(gone, part.n)"
    below = f"filter(slice(nodes, top.n + 2, top.last - top.n), part -> {heard})"
    return _bound(dropped, "gone", f"transform({chosen}, top -> array_join(transform({below}, part -> part.text), ''))")


#: (parent, n, tag) of the nodes by parent; remaining elements of the content have theirs, other nodes -1.
SIBLINGS = "sort_array({})".format(_bound("struct(removed, content)", "known", """transform(nodes, node -> named_struct(
    'parent', if(node.text IS NULL AND NOT get(known.removed, node.n) AND array_contains(node.path, known.content), node.parent, -1),
    'n', node.n, 'tag', node.tag))"""))
#: For each node whether it is a heading whose next remaining element is one of the same level.
BARE_HEADINGS = "transform({}, node -> node.bare)".format(_bound(SIBLINGS, "siblings", f"""sort_array(transform(siblings, (node, i) -> named_struct(
    'n', node.n, 'bare', coalesce(node.parent >= 0 AND node.tag IN ({", ".join(map(_quoted, HEADINGS))})
        AND get(siblings, i + 1).parent = node.parent AND get(siblings, i + 1).tag = node.tag, false))))"""))


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\s\x1c-\x1f\x85\p{Z}]+", " "))


def extract_pieces(pages: DataFrame, selectors: Selectors = Selectors()) -> DataFrame:
    """(page_id, url) plus raw title, blocks, categories, footer, absolute links and, for a bad page, the error.

    Title, blocks, categories and footer are null where an element is missing; a bad page has nothing but its error.
    Title, categories and footer are read from the whole page, blocks and links from what the removals leave.
    """
    removed = _matches_any([steps for steps in map(_steps, selectors.removed) if len(steps) == 1], "content")
    for selector in selectors.removed:
        if len(_steps(selector)) > 1:
            removed = f"zip_with({removed}, {matches(selector, 'content')}, (a, b) -> a OR b)"
    if selectors.blocks:
        blocks = _among(matches(selectors.blocks, "content"))
    else:
        blocks = _bound("content", "top", "filter(nodes, node -> node.parent = top AND node.text IS NULL)")
    anchors = _among(matches(selectors.links, "0" if selectors.links_anywhere else "content"))
    rows = page_nodes(pages).selectExpr("*", f"{_first(matches(selectors.content))} AS content",
                                        f"{_first(matches(selectors.category_box))} AS box", "transform(nodes, node -> false) AS none")
    rows = rows.selectExpr("*", f"{_inherited(removed)} AS removed")
    rows = rows.selectExpr("*", f"zip_with(removed, {_inherited(BARE_HEADINGS)}, (a, b) -> a OR b) AS dropped")
    rows = rows.selectExpr("*", f"slice({_among(matches(selectors.title))}, 1, 1) AS titles", f"slice({_among(matches(selectors.footer))}, 1, 1) AS footers",
                           f"{_among(matches(selectors.categories, 'box'))} AS boxed", f"{_left(blocks)} AS parts", f"{_left(anchors)} AS anchors")
    rows = rows.selectExpr(
        "page_id", "url", f"get({_texts('titles', 'none')}, 0) AS title", f"if(content IS NOT NULL, {_texts('parts', 'dropped')}, NULL) AS blocks",
        f"if(box IS NOT NULL, {_texts('boxed', 'none')}, NULL) AS categories", f"get({_texts('footers', 'none')}, 0) AS footer",
        """CASE WHEN content IS NOT NULL THEN filter(transform(anchors, node -> node.link), link -> link IS NOT NULL)
            WHEN error IS NULL THEN cast(array() AS array<string>) END AS links""", "error")
    return rows.withColumns({"title": _spaced(F.col("title")), "categories": F.transform("categories", _spaced)})
