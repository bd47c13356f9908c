"""English stemmer after the published Porter2 description, as an Arrow column function.

Meant for distinct words: ``operators.vocabulary`` stems every word of a corpus once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values from the published algorithm.
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous",
    "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)
LI_ENDINGS = "cdeghkmnrt"

_REGION = re.compile("[aeiouy][^aeiouy]")
_PREFIX = re.compile("gener|commun|arsen")
_VOWEL = re.compile("[aeiouy]")
_SHORT_END = re.compile("(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")
_DOUBLE = re.compile("(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$")


def _after(word: str, start: int) -> int:
    match = _REGION.search(word, start)
    return match.end() if match else len(word)


def _longest(word: str, endings) -> str | None:
    found = [ending for ending in endings if word.endswith(ending)]
    return max(found, key=len) if found else None


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and _VOWEL.search(word, 0, len(word) - 2):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    ending = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if ending is None:
        return word
    base = word[: -len(ending)]
    if ending in ("eed", "eedly"):
        return base + "ee" if len(base) >= r1 else word
    if not _VOWEL.search(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _DOUBLE.search(base):
        return base[:-1]
    if r1 >= len(base) and _SHORT_END.search(base):
        return base + "e"
    return base


def _derived(word: str, r1: int) -> str:
    ending = _longest(word, STEP_2)
    if ending is None or len(word) - len(ending) < r1:
        return word
    base = word[: -len(ending)]
    if ending == "ogi" and not base.endswith("l"):
        return word
    if ending == "li" and base[-1:] not in LI_ENDINGS:
        return word
    return base + STEP_2[ending]


def _derived_again(word: str, r1: int, r2: int) -> str:
    ending = _longest(word, STEP_3)
    if ending is None or len(word) - len(ending) < (r2 if ending == "ative" else r1):
        return word
    return word[: -len(ending)] + STEP_3[ending]


def _residual(word: str, r2: int) -> str:
    ending = _longest(word, STEP_4)
    if ending is None or len(word) - len(ending) < r2:
        return word
    base = word[: -len(ending)]
    return word if ending == "ion" and not base.endswith(("s", "t")) else base


def _final(word: str, r1: int, r2: int) -> str:
    base = word[:-1]
    if word.endswith("e") and (len(base) >= r2 or (len(base) >= r1 and not _SHORT_END.search(base))):
        return base
    if word.endswith("ll") and len(base) >= r2:
        return base
    return word


@lru_cache(maxsize=200_000)
def stem_word(word: str) -> str:
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    if len(word) < 3:
        return word
    word = word.removeprefix("'")
    word = re.sub("(^|[aeiouy])y", r"\1Y", word)
    prefix = _PREFIX.match(word)
    r1 = prefix.end() if prefix else _after(word, 0)
    r2 = _after(word, r1)

    ending = _longest(word, ("'", "'s", "'s'"))
    word = _plural(word[: -len(ending)] if ending else word)
    if word not in AFTER_1A:
        word = _past(word, r1)
        word = re.sub("(?<=.[^aeiouy])[yY]$", "i", word)
        word = _derived(word, r1)
        word = _derived_again(word, r1, r2)
        word = _residual(word, r2)
        word = _final(word, r1, r2)
    return word.replace("Y", "y")


@F.pandas_udf(T.StringType())
def stem(words: pd.Series) -> pd.Series:
    return words.map(stem_word, na_action="ignore")
