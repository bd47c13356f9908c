"""Secret scans: fixed patterns, and values in credential contexts that would take many guesses.

The cost of guessing a value is the cheapest way to spell it as words, dates, repeats, keyboard walks, references,
placeholders and brute-force spans, found by dynamic programming over its positions.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.byte_bpe import read_ranks

# Fixed patterns. With re.ASCII, either case of the words means A-Z and a-z alone.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")
# Contexts whose values are judged by guess cost. The value is looked ahead at, as it may itself be a context of the next.
_CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:(?:pwd|pass(?:word|wd|phrase|code)?|secret|token|api_?key|credentials?|auth(?:orization)?|bearer|private_?key|access_?key|client_?secret)["']?(?:[\x20\t]*[:=][\x20\t]*|[\x20\t]+is[\x20\t]+)|bearer[\x20\t]+)["']?(?=([^\s"',;<>]{6,}))""",
    re.ASCII | re.IGNORECASE)

# Rows of keys on a common keyboard.
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_NEXT = {(a, b) for row in _ROWS for x in (row, row[::-1]) for a, b in zip(x, x[1:], strict=False)}
_DATES = (
    (re.compile(r"(?:19|20)\d\d"), 120),
    (re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"), 120 * 365),
    (re.compile(r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d"), 120 * 365))
# Not secrets but where to find one, or what to put in its place: the kind of segment, and log10 of the guesses for it.
_REFERENCE = re.compile(
    r"""\$\{[A-Za-z_][A-Za-z0-9_.]*\}|\$\([A-Za-z_][A-Za-z0-9_.]*\)|\$\{?\{\x20*[A-Za-z_][A-Za-z0-9_.]*\x20*\}\}?|\{\{[A-Za-z_][A-Za-z0-9_.]*\}\}|%[A-Za-z_]+%|\$[A-Z]+(?:_[A-Z]+)+(?![A-Za-z0-9_])|(?:process\.env|os\.environ(?:\.get)?|os\.getenv|System\.getenv|env|secrets|vars|config|settings)(?:\.[A-Za-z_]+(?![A-Za-z0-9_])|[\[(])""",
    re.ASCII)
_HOST = re.compile(r"(?:https?|ftp|ssh)://[a-z0-9-]+(?:\.[a-z0-9-]+)*(?::[0-9]{1,5})?(?![^/?#])")
_PLACEHOLDER = re.compile(r"(?:your|my|enter|insert|change|replace|example|sample|dummy|fake|some)(?:[_-][a-z]{1,24}){1,6}(?![a-z0-9])")
_LONGEST_WORD = 24
#: A longer walk or repeat that ends before the last characters of its run is never cheapest: what follows it there is a
#: word or brute span inside the run, and going on over it adds at most log10(1 + 24 / 48) < 0.2 for each such segment.
_SURE = 48
_PLAIN = str.maketrans("@431!05$7", "aaeiiosst")


def word_ranks(ranks_path: str) -> dict[str, int]:
    """Words by how common they are: letter-only tokens of a public vocabulary, whose ids grow as words get rarer."""
    words: dict[str, int] = {}
    for token, rank in read_ranks(ranks_path).items():
        word = token.decode("utf-8", "ignore").strip().lower()
        if len(word) >= 3 and word.isalpha():
            words[word] = min(rank, words.get(word, rank))
    return words


def _brute(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100)


def _run_ends(start: int, end: int, least: int) -> Iterator[int]:
    """Ends worth trying for a walk or repeat from ``start`` in a run that ends at ``end``."""
    near = min(end, start + _SURE)
    yield from range(start + least, near + 1)
    yield from range(max(near + 1, end - _LONGEST_WORD), end + 1)


def _notes(value: str, low: str, i: int, words: dict[str, int]) -> Iterator[tuple[int, float]]:
    """(end, price) of references and placeholders that start at ``i``."""
    if (m := _REFERENCE.match(value, i)) is not None:
        yield m.end(), 1.0
    if (m := _HOST.match(low, i)) is not None:
        yield m.end(), 1.0
    if (m := _PLACEHOLDER.match(low, i)) is not None and all(len(w) < 3 or w in words for w in re.split("[_-]", m[0])):
        yield m.end(), 2.0


def guess_cost(value: str, words: dict[str, int], segment: float = 0.3) -> tuple[float, list[tuple[str, int, int]]]:
    """log10 of the guesses for ``value`` and the cheapest segmentation as (kind, start, end).

    Every segment adds ``segment``, at least 0.2, for having to be tried in its place; a brute-force span is one segment
    however long. The empty value costs 0. Work grows with the length of the value.
    """
    n = len(value)
    low = "".join(c if len(c.lower()) != 1 else c.lower() for c in value)
    plain = low.translate(_PLAIN)
    # Per position and per whether the last segment is brute force, which may go on for the price of a character.
    cost = [[0.0, math.inf]] + [[math.inf, math.inf] for _ in range(n)]
    back: list[list[tuple[str, int, int]]] = [[("", 0, 0)] * 2 for _ in range(n + 1)]
    repeat_end = walk_end = 0
    for i in range(n):
        last = 0 if cost[i][0] <= cost[i][1] else 1
        here = cost[i][last] + segment

        def offer(j: int, price: float, kind: str, i: int = i, last: int = last, here: float = here) -> None:
            if here + price < cost[j][0]:
                cost[j][0], back[j][0] = here + price, (kind, i, last)

        char = _brute(value[i])
        cost[i + 1][1], back[i + 1][1] = min((cost[i][1] + char, ("brute", i, 1)), (cost[i][0] + segment + char, ("brute", i, 0)))
        for j in range(i + 3, min(n, i + _LONGEST_WORD) + 1):
            prices = [math.log10(rank + 2) + extra for rank, extra in ((words.get(low[i:j]), 0.0), (words.get(plain[i:j]), 0.6)) if rank is not None]
            if prices:
                offer(j, min(prices) + (0 if value[i:j].islower() else 0.3 if value[i:j].istitle() or value[i:j].isupper() else 0.9), "word")
        if low[i] in "0123":
            for pattern, guesses in _DATES:
                if (m := pattern.match(low, i)) is not None:
                    offer(m.end(), math.log10(guesses), "date")
        for j, price in _notes(value, low, i, words):
            offer(j, price, "reference")
        if i >= repeat_end:
            repeat_end = i + 1
            while repeat_end < n and low[repeat_end] == low[i]:
                repeat_end += 1
        for j in _run_ends(i, repeat_end, 3):
            offer(j, char + math.log10(j - i), "repeat")
        if i >= walk_end - 1:
            walk_end = i + 1
            while walk_end < n and (low[walk_end - 1], low[walk_end]) in _NEXT:
                walk_end += 1
        for j in _run_ends(i, walk_end, 4):
            offer(j, math.log10(47 * 2 * (j - i)), "walk")
    state = 0 if cost[n][0] <= cost[n][1] else 1
    total, parts, j = cost[n][state], [], n
    while j:
        kind, i, state = back[j][state]
        if parts and kind == "brute" and parts[-1][0] == "brute":
            parts[-1] = ("brute", i, parts[-1][2])
        else:
            parts.append((kind, i, j))
        j = i
    return total, parts[::-1]


def scan(text: str, words: dict[str, int], least_cost: float) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, cost) of all spans of a text, by start and kind; cost is that of the value in a context.

    Values in a context count from ``least_cost`` on and are left out where a fixed pattern already covers them.
    """
    found: list[tuple[int, int, int, float | None]] = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                found.append((m.start(), 0, m.end(), guess_cost(m[2], words)[0]))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), None) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), None) for m in _HEX.finditer(text)]
    taken = sorted((a, b) for a, _, b, _ in found)
    reach = [0]
    for _, b in taken:
        reach.append(max(reach[-1], b))
    last = 0
    for m in _CONTEXT.finditer(text):
        a, b = m.span(1)
        before = bisect_left(taken, (b,))
        if a >= last and reach[before] <= a and (cost := guess_cost(m[1], words)[0]) >= least_cost:
            found.append((a, 3, b, cost))
            last = b
    return [(KINDS[k], a, b, c) for a, k, b, c in sorted(found, key=lambda x: x[:3])]


def find_secrets(docs: DataFrame, ranks_path: str, least_cost: float = 10.0) -> DataFrame:
    """doc_id and secrets (array of kind, start_at, end_at, cost) of each row of ``docs``.

    Positions are code points, ends exclusive. Null and empty texts have none; rows that repeat give a row each; other
    columns are ignored.
    """
    words = docs.sparkSession.sparkContext.broadcast(word_ranks(ranks_path))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start_at", pa.int64()), ("end_at", pa.int64()), ("cost", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in (big.slice(k, 500) for k in range(0, big.num_rows, 500)):
                rows = [[dict(zip(("kind", "start_at", "end_at", "cost"), s, strict=True)) for s in scan(t, words.value, least_cost)] if t else [] for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "secrets"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, secrets array<struct<kind string, start_at long, end_at long, cost double>>")


def summarise(found: DataFrame) -> DataFrame:
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start_at"].cast("string"), s["end_at"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"), count("guess"))
