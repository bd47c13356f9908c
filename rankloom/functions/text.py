"""Text analysis as column expressions.

Two analyzers exist. The primary one cuts text at ASCII white space, cleans each token and keeps
ASCII alphanumeric words; the standard one follows the public word-break rules.
Queries go through a third, shorter chain: they are split at single spaces and not cleaned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words of the primary analyzer, checked before stemming.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "would", "should", "could", "ought", "cannot", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after", "above", "below", "to",
    "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very",
)

# Default English stop words of the standard analyzer.
STANDARD_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
)

# Field numbers of the index.
TITLE, CONTENT, CATEGORIES = 0, 1, 2

# Token delimiters, ASCII punctuation, and the characters a JVM trim removes.
DELIMITERS = " \t\n\r\f"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CONTROL = "".join(map(chr, range(0x21)))


def jvm_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(CONTROL))


def tokens(text: Column) -> Column:
    """Lower-cased white-space tokens; blank text gives one empty token.

    Stripping delimiters first leaves no empty token inside the array, so array indexes are the
    token positions and no per-element filter is needed.
    """
    return F.split(F.btrim(F.lower(text), F.lit(DELIMITERS)), "[ \t\n\r\f]+")


def token_count(text: Column) -> Column:
    """Number of white-space tokens, stop words and junk included."""
    stripped = F.btrim(text, F.lit(DELIMITERS))
    return F.when(stripped == "", F.lit(0)).otherwise(F.size(F.split(stripped, "[ \t\n\r\f]+")))


def clean_token(token: Column) -> Column:
    """Strip punctuation at both ends, then what a JVM trim removes."""
    return jvm_trim(F.btrim(token, F.lit(PUNCTUATION)))


def is_word(token: Column) -> Column:
    # \z, not $: the latter also matches before a trailing line separator.
    return token.rlike(r"^[A-Za-z0-9]+\z")


def is_stop_word(token: Column) -> Column:
    return token.isin(*STOP_WORDS)


def categories_text(categories: Column) -> Column:
    return F.lower(F.array_join(categories, " "))


# Marks that the public word-break rules keep between two letters, between two digits.
_IN_WORD, _IN_NUMBER = ".:'\u00b7\u2018\u2019", ".,;'\u2018\u2019"
_LETTER, _DIGIT = r"[\p{L}\p{M}]", r"\p{Nd}"
#: One character between words. It repeats nothing, so that texts without blanks don't exhaust the stack.
_BETWEEN = (rf"(?!(?<={_LETTER})[{_IN_WORD}](?={_LETTER}))(?!(?<={_DIGIT})[{_IN_NUMBER}](?={_DIGIT}))" r"[^\p{L}\p{M}\p{N}_]")
#: Longer words are cut into pieces of so many characters.
STANDARD_LONGEST = 255


def standard_tokens(text: Column) -> Column:
    """Lower-cased words by the public word-break rules: "don't", "3.14", "foo_bar" and "u.s.a" are one word each.

    Pieces without a letter or digit don't count; a longer word than STANDARD_LONGEST gives several.
    """
    words = F.filter(F.split(F.lower(text), _BETWEEN), lambda w: w.rlike(r"[\p{L}\p{N}]"))
    return F.flatten(F.transform(words, lambda w: F.regexp_extract_all(w, F.lit(rf"(?s).{{1,{STANDARD_LONGEST}}}"), F.lit(0))))


def is_standard_stop_word(token: Column) -> Column:
    return token.isin(*STANDARD_STOP_WORDS)


def keyword_words(text: Column) -> Column:
    """Words of a query text: split at single spaces, trimmed, empties dropped."""
    return F.filter(F.transform(F.split(text, " "), jvm_trim), lambda word: word != "")


def split_dropping_tail(text: Column, pattern: str) -> Column:
    """Split without the empty strings a trailing separator run leaves behind.

    Text that holds no separator stays whole, also when it is empty.
    """
    parts = F.split(text, pattern)
    filled = F.filter(
        F.transform(parts, lambda part, i: F.when(part != "", i + 1)), lambda n: n.isNotNull()
    )
    last = F.coalesce(F.array_max(filled), F.lit(0))
    return F.when(F.size(parts) == 1, parts).otherwise(F.slice(parts, F.lit(1), last))


def pipe_split(text: Column) -> Column:
    return split_dropping_tail(text, r"\|")


def pipe_join(values: Column) -> Column:
    return F.array_join(values, "|")
