import pytest
from pyspark.sql import functions as F

from rankloom.functions.stemmer import stem, stem_word
from rankloom.operators.vocabulary import grown_vocabulary, vocabulary, with_stems
from rankloom.session import materialise

# From the sample vocabulary and tables of the published algorithm.
STEMS = {
    "consign": "consign", "consigned": "consign", "consigning": "consign", "consignment": "consign",
    "consist": "consist", "consisted": "consist", "consistency": "consist", "consistently": "consist",
    "consolation": "consol", "consolatory": "consolatori", "consoled": "consol", "consolingly": "consol",
    "conspicuous": "conspicu", "conspiracy": "conspiraci", "conspirators": "conspir",
    "knack": "knack", "knackeries": "knackeri", "knavish": "knavish", "kneaded": "knead", "knees": "knee",
    "knightly": "knight", "knocked": "knock", "knots": "knot", "knitted": "knit",
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes", "inning": "inning", "outing": "outing", "canning": "canning",
    "herrings": "herring", "proceed": "proceed", "exceeds": "exceed", "succeed": "succeed",
    "generate": "generat", "general": "general", "generous": "generous", "communism": "communism", "arsenal": "arsenal",
    "ties": "tie", "cries": "cri", "gas": "gas", "this": "this", "gaps": "gap", "kiwis": "kiwi", "caresses": "caress",
    "luxuriating": "luxuri", "hopping": "hop", "hoping": "hope", "agreed": "agre", "feed": "feed",
    "cry": "cri", "by": "by", "say": "say", "enjoy": "enjoy", "youth": "youth", "relational": "relat", "conditional": "condit",
    "rationalize": "ration", "formality": "formal", "sensibilities": "sensibl", "hopefulness": "hope", "analogy": "analog",
    "adoption": "adopt", "replacement": "replac", "controllable": "control", "rate": "rate", "cease": "ceas", "at": "at",
    "fluently": "fluentli", "easily": "easili", "x1": "x1", "2018": "2018",
}


@pytest.mark.parametrize("word", STEMS)
def test_stem(word):
    assert stem_word(word) == STEMS[word]


def test_stemmer_as_column(spark):
    words = spark.createDataFrame([("foxes",), (None,)], "w string")
    assert [r.s for r in words.select(stem("w").alias("s")).collect()] == ["fox", None]


def test_vocabulary_join_for_large_vocabularies(spark):
    """A shuffled join and a broadcast one give the same."""
    words = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 > 0, "running").otherwise(F.concat(F.lit("walks"), F.col("id") % 50)).alias("term"))
    stems = materialise(vocabulary(words), "test-vocabulary")
    small = with_stems(words, stems)
    large = with_stems(words, stems.hint("merge"))
    assert sorted(small.collect()) == sorted(large.select(*small.columns).collect())
    assert small.filter("term = 'run'").count() == words.filter("term = 'running'").count()


def test_vocabulary_grows_by_new_words_only(spark):
    words = spark.createDataFrame([(w,) for w in ["running", "running", "flies", "cats", "sky"]], "term string")
    kept = spark.createDataFrame([("running", "kept as it was"), ("unused", "unus")], "token string, stem string")
    grown = {r.token: (r.n_occ, r.stem, r.is_new) for r in grown_vocabulary(words, kept).collect()}
    assert grown == {"running": (2, "kept as it was", False), "flies": (1, "fli", True), "cats": (1, "cat", True), "sky": (1, "sky", True)}
    assert grown_vocabulary(words.limit(0), kept).count() == 0
