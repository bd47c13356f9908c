"""Tokens, postings and corpus statistics.

Postings are kept in long form, one row per (term, field, document) with at least one hit, and
carry the length of the field. Groups are bounded by one document, whatever the term.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as tx
from rankloom.functions.highlight import let
from rankloom.operators.vocabulary import with_stems, written_vocabulary

BLOCK_DOCS = 65_536


def _field_texts(title: Column, content: Column, categories: Column) -> list[tuple[int, Column]]:
    return [(tx.TITLE, title), (tx.CONTENT, content), (tx.CATEGORIES, F.array_join(categories, " "))]


def _fields(docs: DataFrame) -> DataFrame:
    """One row per document and field, from one pass over the documents."""
    entries = _field_texts(F.col("title"), F.col("content"), F.col("categories"))
    structs = [F.struct(F.lit(number).alias("field_id"), value.alias("text")) for number, value in entries]
    return docs.select("doc_id", F.explode(F.array(*structs)).alias("f")).select("doc_id", "f.field_id", "f.text")


def raw_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, field_id, doc_len, pos, token): every white-space token advances the position."""
    # The length goes into a step of its own: next to the generator it would be computed per token.
    return (
        _fields(docs).withColumn("doc_len", tx.token_count(F.col("text")))
        .select("doc_id", "field_id", "doc_len", F.posexplode(tx.tokens(F.col("text"))).alias("pos", "token"))
        .filter(F.col("token") != "")
    )


def clean_words(docs: DataFrame, keep_stop_words: bool = False) -> DataFrame:
    """(doc_id, field_id, doc_len, pos, term) with punctuation, junk and stop words removed."""
    cleaned = raw_tokens(docs).select(
        "doc_id", "field_id", "doc_len", "pos", tx.clean_token(F.col("token")).alias("term")
    )
    words = cleaned.filter(tx.is_word(F.col("term")))
    return words if keep_stop_words else words.filter(~tx.is_stop_word(F.col("term")))


def _is_kept(token: Column) -> Column:
    return (token != "") & ~tx.is_standard_stop_word(token)


def standard_words(docs: DataFrame) -> DataFrame:
    """Words of the standard analyzer. Stop words leave gaps in positions but not in lengths."""
    cut = _fields(docs).select("doc_id", "field_id", tx.standard_tokens(F.col("text")).alias("tokens"))
    return (
        cut.withColumn("doc_len", F.size(F.filter("tokens", _is_kept)))
        .select("doc_id", "field_id", "doc_len", F.posexplode("tokens").alias("pos", "term"))
        .filter(_is_kept(F.col("term")))
    )


def _by_document(docs: DataFrame) -> DataFrame:
    """Spread documents by id before they are cut into words: the shuffle moves compact text instead of one row per word.

    Rows of one id come together in an array, with a number it has one.
    """
    placed = docs.select("doc_id", "title", "content", "categories").repartition("doc_id")
    return placed.groupBy("doc_id").agg(F.collect_list(F.struct("title", "content", "categories")).alias("rows"))


_WORDS = "array<struct<field_id:int,doc_len:int,term:string,pos:int>>"


def _grouped_words(words: Column) -> Column:
    """Words of a document as postings: equal ones stand next to each other once they are sorted, and are cut out as a slice.

    Nothing outgrows the document, and no row is made for a word, so a task holds no table of all its words.
    """
    def differs(w: Column, before: Column) -> Column:
        return (w["term"] != before["term"]) | (w["field_id"] != before["field_id"]) | (w["doc_len"] != before["doc_len"])

    def posting(x: Column, i: Column) -> Column:
        first = F.get(x["first"], i)
        last = F.coalesce(F.get(x["first"], i + 1), F.size(x["words"]))
        run = F.transform(F.slice(x["words"], first + 1, last - first), lambda w: w["pos"])
        return let(F.get(x["words"], first), lambda w: F.struct(
            w["term"].alias("term"), w["field_id"].alias("field_id"), w["doc_len"].alias("doc_len"), run.alias("positions")))

    def cut(x: Column) -> Column:
        first = F.filter(F.transform(x["words"], lambda w, i: F.when(
            (i == 0) | differs(w, F.get(x["words"], F.greatest(i - 1, F.lit(0)))), i)), lambda i: i.isNotNull())
        return let(F.struct(x["words"].alias("words"), first.alias("first")), lambda y: F.transform(
            y["first"], lambda _, i: posting(y, i)))

    return let(F.struct(F.sort_array(words).alias("words")), cut)


def _postings_of(docs: DataFrame, words_of: Callable[[Column], Column]) -> DataFrame:
    """Postings where ``words_of`` gives the words (field_id, doc_len, term, pos) of a row (title, content, categories)."""
    words = F.flatten(F.transform("rows", words_of))
    posted = _by_document(docs).select("doc_id", F.inline(_grouped_words(words)))
    return posted.select("term", "field_id", "doc_id", F.size("positions").alias("tf"), "positions", "doc_len")


def _words_of_fields(row: Column, tokens: Callable[[Column], Column], length: Callable[[Column, Column], Column],
                     term: Callable[[Column], Column], kept: Callable[[Column], Column]) -> Column:
    def of(field_id: int, text: Column) -> Column:
        found = let(tokens(text), lambda cut: let(length(text, cut), lambda n: F.filter(F.transform(cut, lambda t, i: F.struct(
            F.lit(field_id).alias("field_id"), n.alias("doc_len"), term(t).alias("term"), i.alias("pos"))), lambda w: kept(w["term"]))))
        return F.coalesce(found.cast(_WORDS), F.array().cast(_WORDS))

    return F.concat(*[of(n, text) for n, text in _field_texts(row["title"], row["content"], row["categories"])])


def _clean_words_of(row: Column) -> Column:
    return _words_of_fields(row, tx.tokens, lambda text, _: tx.token_count(text), tx.clean_token,
                            lambda w: tx.is_word(w) & ~tx.is_stop_word(w))


def _standard_words_of(row: Column) -> Column:
    return _words_of_fields(row, tx.standard_tokens, lambda _, cut: F.size(F.filter(cut, _is_kept)), lambda t: t, _is_kept)


def postings(docs: DataFrame, stem: bool = False) -> DataFrame:
    """(term, field_id, doc_id, tf, positions, doc_len) of the primary analyzer."""
    posted = _postings_of(docs, _clean_words_of)
    if not stem:
        return posted
    # Stems meet a word once per field and document; words with one stem share a posting there.
    stemmed = with_stems(posted, written_vocabulary(clean_words(docs)))
    grouped = stemmed.groupBy("doc_id", "field_id", "term", "doc_len").agg(
        F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions")
    )
    return grouped.select("term", "field_id", "doc_id", F.size("positions").alias("tf"), "positions", "doc_len")


def standard_postings(docs: DataFrame) -> DataFrame:
    """Same columns for the standard analyzer, where ``doc_len`` counts the kept words."""
    return _postings_of(docs, _standard_words_of)


def doc_lengths(docs: DataFrame) -> DataFrame:
    """(doc_id, field_id, len): raw white-space token count of every field."""
    return _fields(docs).select("doc_id", "field_id", tx.token_count(F.col("text")).alias("len"))


def field_stats(lengths: DataFrame) -> DataFrame:
    """(field_id, total_len, n_docs, avg_len): three rows."""
    return lengths.groupBy("field_id").agg(
        F.sum("len").alias("total_len"), F.count("*").alias("n_docs"),
        (F.sum("len") / F.count("*")).alias("avg_len"),
    )


def standard_field_stats(posted: DataFrame) -> DataFrame:
    """Same columns for the standard analyzer: kept words, and documents that have any."""
    lengths = posted.groupBy("doc_id", "field_id").agg(F.max("doc_len").alias("len"))
    return field_stats(lengths)


def term_stats(posted: DataFrame) -> DataFrame:
    """(term, field_id, df): documents holding the term in that field."""
    return posted.groupBy("term", "field_id").agg(F.count("*").alias("df"))


def wide_postings(posted: DataFrame, *beside: str) -> DataFrame:
    """(term, doc_id, tf[3], positions[3]): fields side by side, after columns ``beside`` that the document decides."""
    def slot(number: int, column: str, empty: Column) -> Column:
        return F.coalesce(F.max(F.when(F.col("field_id") == number, F.col(column))), empty)

    no_positions = F.array().cast("array<int>")
    numbers = (tx.TITLE, tx.CONTENT, tx.CATEGORIES)
    return posted.groupBy("term", *beside, "doc_id").agg(
        F.array(*[slot(n, "tf", F.lit(0)) for n in numbers]).alias("tf"),
        F.array(*[slot(n, "positions", no_positions) for n in numbers]).alias("positions"),
    )


def posting_lists(posted: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, df, entries): the documents of a term in id order.

    A list is cut into blocks of ``block_docs`` consecutive document ids. A frequent term thereby
    spreads over many rows and tasks, and no row outgrows a block.
    """
    # Dealt by block once, which holds for both groupings.
    placed = posted.withColumn("block", F.floor(F.col("doc_id") / block_docs)).repartition("term", "block")
    return (
        wide_postings(placed, "block").groupBy("term", "block")
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", "tf", "positions"))).alias("entries"))
        .select("term", "block", F.size("entries").alias("df"), "entries")
    )
