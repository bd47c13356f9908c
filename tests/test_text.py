from pyspark.sql import functions as F

from rankloom.functions import text as tx


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("r")).first().r


def test_fixed_lists():
    assert len(tx.STOP_WORDS) == len(set(tx.STOP_WORDS)) == 124
    assert len(tx.STANDARD_STOP_WORDS) == 33


def test_tokens_split_at_ascii_blanks_only(spark):
    assert one(spark, " A\tb\n\fC d e ", tx.tokens(F.col("t"))) == ["a", "b", "c d e"]
    assert one(spark, "  \n", tx.token_count(F.col("t"))) == 0
    assert one(spark, " a  b ", tx.token_count(F.col("t"))) == 2


def test_clean_token(spark):
    cases = {"(fox,": "fox", "a-b!": "a-b", "!!": "", "x\u000b": "x", "x!\u000b": "x!", "café.": "café"}
    for raw, clean in cases.items():
        assert one(spark, raw, tx.clean_token(F.col("t"))) == clean


def test_words_are_ascii_alphanumeric(spark):
    cases = {"a1": True, "café": False, "a-b": False, "": False, "abc ": False}
    for word, expected in cases.items():
        assert one(spark, word, tx.is_word(F.col("t"))) is expected


def test_pipe_split_drops_trailing_empties(spark):
    cases = {"a|b": ["a", "b"], "a||b||": ["a", "", "b"], "": [""], "||": [], "|a": ["", "a"]}
    for raw, parts in cases.items():
        assert one(spark, raw, tx.pipe_split(F.col("t"))) == parts


def test_keyword_words_keep_punctuation(spark):
    assert one(spark, " fox,  \tRed ", tx.keyword_words(F.col("t"))) == ["fox,", "Red"]


def test_standard_tokens(spark):
    cases = {
        "L'été 3.14!": ["l'été", "3.14"], "Don't": ["don't"], "foo_bar __": ["foo_bar"], "U.S.A.": ["u.s.a"], "a.1 1.a": ["a", "1", "1", "a"],
        "1,000;5 a,b": ["1,000;5", "a", "b"], "'quoted' a''b x-y": ["quoted", "a", "b", "x", "y"], "": [], " .": [],
        "x" * 300: ["x" * 255, "x" * 45],
    }
    for raw, words in cases.items():
        assert one(spark, raw, tx.standard_tokens(F.col("t"))) == words
    assert len(one(spark, "a." * 30_000, tx.standard_tokens(F.col("t")))) == -(-59_999 // 255)
