"""Main text of web pages: a linear-chain conditional random field over leaf blocks of the page.

A block is the text between two tags that start or end a block. Its features come from the tags, classes and ids above
it and from its own text. The field is trained on labelled pages and decoded by the Viterbi algorithm.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*+(?:>|\Z)""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose content is no text of a page.
_SILENT = frozenset("head script style noscript template svg math iframe object textarea select button title audio video canvas datalist".split())
_RAW = frozenset("script style textarea title noscript iframe template".split())
#: An opening tag ends an open one of the same group.
_GROUPS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_STAYS_IN_P = _INLINE | _VOID

# Words in classes and ids, and the feature each group gives.
_NAMED = {
    "nav": r"nav|navbar|navigation|menu|menus|breadcrumb|breadcrumbs|toc|pagination|pager|tabs|links|sitemap|skip",
    "footer": r"footer|foot|copyright|colophon|legal|bottom|imprint",
    "header": r"header|masthead|topbar|top|logo|branding|site-header|siteheader|hero",
    "side": r"sidebar|side|aside|rail|widget|widgets|column-right|secondary",
    "ad": r"ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|adsense|adbox|adslot|teaser",
    "notice": r"cookie|cookies|consent|notice|notices|gdpr|alert|popup|modal|overlay|privacy|disclaimer|toast|paywall|message|warning",
    "comment": r"comment|comments|disqus|reply|replies|discussion|respond|feedback|commentlist|reader|readers|responses",
    "form": r"form|login|signup|signin|register|subscribe|subscription|newsletter|search|searchbox|poll|contact",
    "social": r"share|sharing|social|related|recommended|recommendations|more|tags|trending|popular|follow|byline|meta",
    "main": r"article|articles|content|contents|post|entry|story|main|body|text|page-content|prose|maincontent|articlebody",
}
_NAMES = {word: group for group, words in _NAMED.items() for word in words.split("|")}
_TAGS = {"nav": "nav", "footer": "footer", "header": "header", "aside": "side", "form": "form", "fieldset": "form", "article": "main", "main": "main", "dialog": "notice", "menu": "nav"}
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass(frozen=True)
class Block:
    text: str
    features: tuple[str, ...]


def _open_features(tag: str, attributes: str, above: frozenset[str]) -> frozenset[str]:
    own = set()
    if (group := _TAGS.get(tag)) is not None:
        own.add(f"tag:{group}")
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id", "role"):
                for word in _SPLIT.split(value):
                    if (group := _NAMES.get(word.lower())) is not None:
                        own.add(f"name:{group}")
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
                own.add("hidden")
    return above | own if own else above


def _text_features(text: str, linked: int, tag: str) -> list[str]:
    words = text.count(" ") + 1
    share = linked / len(text)
    out = [f"words:{0 if words < 3 else 1 if words < 8 else 2 if words < 20 else 3}", f"links:{0 if share == 0 else 1 if share < 0.5 else 2}"]
    if text[-1] in ".!?":
        out.append("stops")
    if "©" in text or "All rights" in text:
        out.append("rights")
    out.append("leaf:heading" if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else f"leaf:{tag}" if tag in ("p", "li", "td", "div") else "leaf:other")
    return out


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order. Text under tags that show none is left out, broken markup is read as far as it goes."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = [("", frozenset())]
    parts: list[str] = []
    linked = in_link = silent = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                tag, features = stack[-1]
                out.append(Block(text, (*sorted(features), *_text_features(text, min(linked, len(text)), tag))))
            parts.clear()
        linked = 0

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece and not silent:
            parts.append(piece)
            if in_link:
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not silent:
                parts.append(references.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _INLINE:
            if tag == "a" and not silent:
                in_link = not closing
            continue
        if tag in _VOID:
            if tag in ("br", "hr") and not silent:
                parts.append(" ")
                if tag == "hr":
                    flush()
            continue
        if not silent:
            flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    for name, _ in stack[k:]:
                        silent -= name in _SILENT
                    del stack[k:]
                    in_link = 0
                    break
            continue
        if tag == "body":  # ends a head that was left open
            silent = 0
            stack = [s for s in stack if s[0] not in _SILENT]
        ends = _GROUPS.get(tag, {"p"})
        while len(stack) > 1 and stack[-1][0] in ends:
            stack.pop()
        if m[3].endswith("/") and tag in ("svg", "math", "path", "iframe", "script"):
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
            close = page.find(">", end.start()) if end else -1
            at = len(page) if end is None or close < 0 else close + 1
            continue
        stack.append((tag, _open_features(tag, m[3], stack[-1][1])))
        silent += tag in _SILENT
    if not silent:
        flush()
    return out


@dataclass
class Field:
    """Weights of a two-state chain; state 1 is main text. Features add to state 1 only."""

    weights: dict[str, float]
    change: np.ndarray  # from state, to state
    start: float

    def decode(self, chain: list[Block]) -> list[bool]:
        """The likeliest states (Viterbi); an empty chain has none."""
        if not chain:
            return []
        weights, (c00, c01), (c10, c11) = self.weights, *self.change.tolist()
        back = []
        zero, one = 0.0, self.start + sum(weights.get(f, 0.0) for f in chain[0].features)
        for block in chain[1:]:
            gain = sum(weights.get(f, 0.0) for f in block.features)
            stay0, stay1 = zero + c00 >= one + c10, one + c11 >= zero + c01
            back.append((not stay0, stay1))
            zero, one = (zero + c00 if stay0 else one + c10), gain + (one + c11 if stay1 else zero + c01)
        state = one > zero
        states = [state]
        for from_zero, from_one in reversed(back):
            state = from_one if state else from_zero
            states.append(state)
        return states[::-1]


def train(pages: list[tuple[list[Block], list[bool]]], rounds: int = 200, penalty: float = 1e-3) -> Field:
    """Maximise the penalised likelihood of labelled chains by gradient ascent with momentum and scaling."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for chain, _ in pages for b in chain for f in b.features})
    index = {f: k for k, f in enumerate(names)}
    longest = max(len(chain) for chain, _ in pages)
    x = np.zeros((len(pages), longest, len(names)), np.float32)
    y, mask = np.zeros((len(pages), longest), int), np.zeros((len(pages), longest))
    for n, (chain, labels) in enumerate(pages):
        for k, (block, label) in enumerate(zip(chain, labels, strict=True)):
            x[n, k, [index[f] for f in block.features]] = 1
            y[n, k], mask[n, k] = label, 1
    theta = np.zeros(len(names) + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = mask.sum()
    for step in range(1, rounds + 1):
        w, change, start = theta[: len(names)], theta[len(names) : -1].reshape(2, 2), theta[-1]
        emit = np.stack([np.zeros(mask.shape), x @ w], -1)
        emit[:, 0, 1] += start
        ahead = np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for k in range(1, longest):
            new = np.logaddexp(ahead[:, k - 1, 0, None] + change[0], ahead[:, k - 1, 1, None] + change[1]) + emit[:, k]
            ahead[:, k] = np.where(mask[:, k, None] > 0, new, ahead[:, k - 1])
        behind = np.zeros_like(emit)
        pair = np.zeros((2, 2))
        norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        for k in range(longest - 1, 0, -1):
            after = behind[:, k] + emit[:, k]
            each = np.exp(ahead[:, k - 1, :, None] + change + after[:, None, :] - norm[:, None, None]) * mask[:, k, None, None]
            pair += each.sum(0)
            new = np.logaddexp(change[:, 0] + after[:, 0, None], change[:, 1] + after[:, 1, None])
            behind[:, k - 1] = np.where(mask[:, k, None] > 0, new, behind[:, k])
        one = np.exp(ahead[:, :, 1] + behind[:, :, 1] - norm[:, None]) * mask
        seen = np.zeros((2, 2))
        both = mask[:, 1:] > 0
        np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
        off = (y * mask - one)
        gradient = np.concatenate([np.einsum("nk,nkf->f", off, x), (seen - pair).ravel(), [off[:, 0].sum()]]) / total - penalty * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(names, theta[: len(names)].tolist(), strict=True)), theta[len(names) : -1].reshape(2, 2), float(theta[-1]))


# Labelled pages: layouts whose parts are marked as main text or not, filled with made-up words.

_WRAPS = ('<article>{}</article>', '<main>{}</main>', '<main><article>{}</article></main>', '<div class="content">{}</div>', '<div id="main-content"><div class="post">{}</div></div>', '<div class="entry-content">{}</div>', '<section class="story-body">{}</section>', '<div role="main">{}</div>', '<table><tr><td>{}</td></tr></table>', '<div>{}</div>')
_AROUND = {
    "nav": ('<nav><ul>{links}</ul></nav>', '<div class="menu"><ul>{links}</ul></div>', '<div id="navbar">{links}</div>', '<ol class="breadcrumb">{links}</ol>', '<div role="navigation">{links}</div>', '<ul class="main-nav">{links}</ul>'),
    "top": ('<header><h1>{short}</h1><p>{line}</p></header>', '<div class="site-header"><h2>{short}</h2></div>', '<div id="masthead">{short}</div>', '<header>{links}</header>', '<div class="page-header"><p>{line}</p></div>'),
    "ad": ('<div class="ad">{line}</div>', '<div class="advert"><p>{line}</p></div>', '<div class="sponsored-box">{text}</div>', '<div id="banner-ad"><a href="#">{line}</a></div>', '<aside class="promo"><p>{line}</p></aside>', '<section class="ads main-ad"><p>{line}</p></section>'),
    "notice": ('<div class="cookie-notice"><p>{line}</p></div>', '<div class="notice">{text}</div>', '<div id="consent-popup"><p>{line}</p></div>', '<div role="alert">{line}</div>', '<div class="gdpr content-notice"><p>{text}</p></div>', '<dialog><p>{line}</p></dialog>'),
    "side": ('<aside><h3>{short}</h3><p>{line}</p></aside>', '<div class="sidebar"><h3>{short}</h3><ul>{links}</ul><p>{text}</p></div>', '<div id="right-rail"><p>{text}</p></div>', '<div class="widget-area"><p>{line}</p></div>', '<aside class="sidebar"><ul>{links}</ul></aside>'),
    "form": ('<form><p>{line}</p><label>{short}</label><input name="q"></form>', '<form class="newsletter"><h3>{short}</h3><p>{line}</p></form>', '<div class="login-form"><p>{line}</p></div>', '<div class="subscribe"><p>{line}</p></div>'),
    "comment": ('<div class="comments"><h3>{short}</h3><p>{text}</p><p>{line}</p></div>', '<section id="comments"><article><p>{text}</p></article><article><p>{line}</p></article></section>', '<ol class="commentlist"><li><p>{text}</p></li><li>{line}</li></ol>', '<div id="disqus_thread"><p>{line}</p></div>', '<div class="reader-comments"><div class="comment-body"><p>{text}</p></div></div>'),
    "more": ('<div class="related"><h3>{short}</h3><ul>{links}</ul></div>', '<div class="share-buttons">{links}</div>', '<p class="byline">{short}</p>', '<div class="tags">{links}</div>'),
    "foot": ('<footer>&copy; {short} &middot; {line}</footer>', '<div class="footer"><p>&copy; {line}</p><p>{line}</p></div>', '<div id="footer"><ul>{links}</ul><p>{text}</p></div>', '<footer><p>{line}</p></footer>', '<div class="copyright">&copy; {short}</div>'),
    "hidden": ('<div style="display:none"><p>{line}</p></div>', '<p hidden>{text}</p>', '<div aria-hidden="true">{line}</div>'),
}
_INSIDE = ("ad", "notice", "comment", "more", "form", "side", "hidden")
_SYLLABLES = "ba co di fe gu ha in jo ka le mi no or pa qua re si to un ve wa".split()


def labelled_pages(n: int, seed: int = 11) -> list[tuple[list[Block], list[bool]]]:
    """``n`` pages with a label per block: a layout from the lists above, words of random syllables."""
    draw = random.Random(seed)
    mark = "⁣"  # stands before every word of main text, and goes before features are taken

    def words(low: int, high: int, own: bool) -> str:
        made = [(mark if own else "") + "".join(draw.choices(_SYLLABLES, k=draw.randint(1, 4))) for _ in range(draw.randint(low, high))]
        return " ".join(made)

    def line(own: bool, low: int = 3, high: int = 14) -> str:
        return words(low, high, own).capitalize() + draw.choice((".", ".", ".", "", "!"))

    def fill(layout: str) -> str:
        links = "".join(draw.choice(('<li><a href="#">{}</a></li>', '<li><a href="#">{}</a></li>', '<a href="#">{}</a> ')).format(words(1, 3, False)) for _ in range(draw.randint(2, 7)))
        return layout.format(links=links, short=words(1, 3, False), line=line(False), text=" ".join(line(False, 6, 20) for _ in range(draw.randint(2, 5))))

    pages = []
    for _ in range(n):
        part = lambda kind: fill(draw.choice(_AROUND[kind]))
        body = [f"<h1>{words(3, 9, True)}</h1>"] if draw.random() < 0.8 else []
        for _ in range(draw.randint(1, 9)):
            roll = draw.random()
            text = " ".join(line(True, 1, 25) for _ in range(draw.choice((1, 1, 2, 4, 6))))
            if roll < 0.68:
                body.append(draw.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br><p>")).format(text))
            elif roll < 0.74:
                body.append(f"<h2>{words(1, 6, True)}</h2>")
            elif roll < 0.8:
                body.append("<ul>" + "".join(f"<li>{line(True, 1, 9)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>")
            elif roll < 0.84:
                body.append(f"<p>{line(True)} <a href='#'>{words(1, 4, True)}</a> {line(True)}</p>")
            elif roll < 0.88:
                body.append(f"<blockquote>{text}</blockquote>")
            elif roll < 0.91:
                body.append("<table>" + f"<tr><td>{words(1, 3, True)}</td><td>{words(1, 3, True)}</td></tr>" * draw.randint(1, 3) + "</table>")
            else:
                body.append(part(draw.choice(_INSIDE)))
        body = body if any(mark in b for b in body) else [*body, f"<p>{line(True)}</p>"]
        wrapped = draw.choice(_WRAPS[:3] if draw.random() < 0.4 else _WRAPS).format("".join(body))
        before = [part(k) for k in ("notice", "top", "nav", "ad", "form", "side", "hidden") if draw.random() < 0.45]
        after = [part(k) for k in ("more", "side", "comment", "form", "ad", "notice", "foot") if draw.random() < 0.45]
        page = "<html><head><title>x</title></head><body>" + "".join(before) + wrapped + "".join(after) + "</body></html>"
        chain = blocks(page)
        labels = [mark in b.text for b in chain]
        plain = blocks(page.replace(mark, ""))
        pages.append((plain, labels))
    return pages


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``.

    Main blocks are joined by one space in page order. A null, empty or unreadable page gives an empty text; rows that
    repeat give a row each; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for big in batches:
            for batch in (big.slice(k, 500) for k in range(0, big.num_rows, 500)):
                texts = []
                for page in batch.column(2).to_pylist():
                    chain = blocks(page or "")
                    texts.append(" ".join(b.text for b, own in zip(chain, model.decode(chain), strict=True) if own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
