"""Keyword highlighting and sentence snippets as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.marking import marked_texts, sentences_of
from rankloom.functions.text import keyword_words

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(text: Column) -> Column:
    """A-Z in small letters; keeps the number of characters."""
    return F.translate(text, _UPPER, _LOWER)


def query_words(keyword: Column) -> Column:
    return F.transform(keyword_words(keyword), F.lower)


def quoted(word: Column) -> Column:
    """Regular expression matching ``word`` literally."""
    return F.concat(F.lit(r"\Q"), F.replace(word, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


_SPANS = "array<struct<first:int,last:int>>"


def _matches(low: Column, word: Column) -> Column:
    """Spans [first, last) of a word's matches, from left to right, as lengths between its matches add up."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans")).cast(f"struct<at:int,spans:{_SPANS}>")

    def step(walk: Column, part: Column) -> Column:
        first = walk["at"] + F.length(part)
        last = first + F.length(word)
        return F.struct(last.alias("at"), F.array_append(walk["spans"], F.struct(first.alias("first"), last.alias("last"))).alias("spans")).cast(f"struct<at:int,spans:{_SPANS}>")

    parts = F.split(low, quoted(word), -1)
    return let(parts, lambda p: F.reduce(F.slice(p, F.lit(1), F.size(p) - 1), start, step))["spans"]


def _merged(spans: Column) -> Column:
    """Spans in order, those that overlap or touch as one."""
    kind = f"struct<done:{_SPANS},first:int,last:int>"
    start = F.struct(F.array().cast(_SPANS).alias("done"), F.lit(-1).alias("first"), F.lit(-1).alias("last")).cast(kind)
    closed = lambda walk: F.when(walk["first"] < 0, walk["done"]).otherwise(F.array_append(walk["done"], F.struct(walk["first"].alias("first"), walk["last"].alias("last"))))

    def step(walk: Column, span: Column) -> Column:
        joins = (walk["first"] >= 0) & (span["first"] <= walk["last"])
        return F.struct(
            F.when(joins, walk["done"]).otherwise(closed(walk)).alias("done"), F.when(joins, walk["first"]).otherwise(span["first"]).alias("first"),
            F.when(joins, F.greatest(walk["last"], span["last"])).otherwise(span["last"]).alias("last")).cast(kind)

    return F.reduce(F.array_sort(spans), start, step, closed)


def mark_words(text: Column, words: Column, tag: str) -> Column:
    """``text`` with a tag around what the words cover, ignoring ASCII case.

    Every word is matched on the original text, from left to right; matches that overlap or touch share one tag. The
    result is longer than the text by a pair of tags per stretch at most, however many words there are.
    """
    def tagged(x: Column) -> Column:
        cut = lambda first, last: F.array_join(F.slice(x["chars"], first + 1, last - first), "")
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(x["spans"], F.greatest(i - 1, F.lit(0)))["last"])
        pieces = F.transform(x["spans"], lambda s, i: F.concat(cut(before(i), s["first"]), F.lit(f"<{tag}>"), cut(s["first"], s["last"]), F.lit(f"</{tag}>")))
        return F.concat(F.array_join(pieces, ""), cut(before(F.size(x["spans"])), F.size(x["chars"])))

    def marked(x: Column) -> Column:
        spans = F.flatten(F.transform(x["found"], lambda w: _matches(x["low"], w)))
        return F.when(F.size(x["found"]) == 0, x["text"]).otherwise(
            let(F.struct(F.split(x["text"], "").alias("chars"), _merged(spans).alias("spans")), tagged))

    bound = let(F.struct(text.alias("text"), fold(text).alias("low"), words.alias("words")), lambda x: F.struct(
        x["text"].alias("text"), x["low"].alias("low"), F.array_distinct(F.filter(x["words"], lambda w: F.contains(x["low"], w))).alias("found")))
    return F.when(text == "", text).otherwise(let(bound, marked))


def joined_words(keyword: Column) -> Column:
    """Words of a query text, joined by blanks."""
    return F.array_join(query_words(keyword), " ")


def highlight(text: Column, keyword: Column, tag: str) -> Column:
    """Mark all words of a query text."""
    return marked_texts(text, joined_words(keyword), F.lit(tag))


def _counted_words(sentence: Column) -> Column:
    """Words of a sentence with blanks on both sides, as ``marking.sentence_score`` takes them. As a match takes the blanks around it, every other word of a row of equal ones counts."""
    def odd(words: Column, word: Column, i: Column) -> Column:
        row = F.array_position(F.transform(F.reverse(F.slice(words, F.lit(1), i)), lambda w: w != word), F.lit(True))
        return F.when((i == 0) | (F.get(words, F.greatest(i - 1, F.lit(0))) != word), True).otherwise(
            F.when(row > 0, row - 1).otherwise(i) % 2 == 0)

    inner = let(F.split(fold(sentence), "[ ]+"), lambda parts: F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))))
    return let(inner, lambda words: F.filter(words, lambda word, i: odd(words, word, i)))


def _sentence_score(sentence: Column, query: Column) -> Column:
    """20 x the rarest word's count plus all counts. ``query`` has the words and the distinct ones, in a struct.

    The sentence is split once; only words it shares with the query are counted.
    """
    def score(x: Column) -> Column:
        shared = F.array_intersect(query["distinct"], x)
        counts = F.transform(shared, lambda w: F.struct(
            F.size(F.filter(x, lambda t: t == w)).alias("n"), F.size(F.filter(query["words"], lambda q: q == w)).alias("times")))
        return let(counts, lambda c: F.when(
            (F.size(c) > 0) & (F.size(c) == F.size(query["distinct"])), F.array_min(F.transform(c, lambda e: e["n"])) * 20).otherwise(0)
            + F.reduce(c, F.lit(0), lambda total, e: total + e["n"] * e["times"]))

    return let(_counted_words(sentence), score)


def sentence_snippet(text: Column, keyword: Column) -> Column:
    """Five best sentences, best first and equal ones in text order, highlighted on one line."""
    return sentences_of(text, joined_words(keyword))
