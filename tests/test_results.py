import json
import random
import re
import time

from pyspark.sql import functions as F

from rankloom.functions.highlight import _sentence_score, highlight, let, query_words, sentence_snippet
from rankloom.functions.json_pointer import json_pointer
from rankloom.functions.marking import sentence_score
from rankloom.operators.requests import METHODS, bad_method, parse_requests
from rankloom.operators.results import fragment_snippet, fragment_snippets, paginate


def one(spark, column):
    return spark.range(1).select(column.alias("r")).first().r


def test_highlight(spark):
    assert one(spark, highlight(F.lit("Red fox, REDder"), F.lit("red FOX"), "b")) == "<b>Red</b> <b>fox</b>, <b>RED</b>der"
    # Words are matched on the text alone, never inside a tag; what overlaps or touches shares one.
    assert one(spark, highlight(F.lit("ax"), F.lit("a b"), "b")) == "<b>a</b>x"
    assert one(spark, highlight(F.lit("thent thn AAA"), F.lit("then ent aa t"), "b")) == "<b>thent</b> <b>t</b>hn <b>AA</b>A"
    assert one(spark, highlight(F.lit("É é Ünder"), F.lit("É ünder"), "b")) == "É <b>é</b> Ünder"
    assert one(spark, highlight(F.lit(r"a.c\E $1"), F.lit(r". \e $1"), "i")) == r"a<i>.</i>c<i>\E</i> <i>$1</i>"
    assert one(spark, highlight(F.lit("plain"), F.lit(""), "b")) == "plain"


def test_highlight_grows_by_its_stretches_only(spark):
    text = "A man ran as an ant. " * 20
    keyword = "a an s span p n " + "a " * 12
    got = one(spark, highlight(F.lit(text), F.lit(keyword), "span"))
    assert got == "<span>A</span> m<span>an</span> r<span>an</span> <span>as</span> <span>an</span> <span>an</span>t. " * 20


def counted(sentence, word):
    return len(re.findall(f"(?i)[ ]+{re.escape(word)}[ ]+", sentence))


def test_sentence_scores_against_patterns(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b", "A", "ab", "x", " ", " ", "  "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    keywords = ["a", "a b", "a a ab", "x b a", "b", ""]
    rows = [(t, k) for t in texts for k in keywords]
    score = let(F.struct(query_words(F.col("k")).alias("words"), F.array_distinct(query_words(F.col("k"))).alias("distinct")), lambda q: _sentence_score(F.col("t"), q))
    got = spark.createDataFrame(rows, "t string, k string").select("t", "k", score.alias("s")).collect()
    for r in got:
        n = [counted(r.t, w) for w in r.k.split()]
        assert r.s == 20 * min(n, default=0) + sum(n), r


def test_sentence_snippet(spark):
    text = "none here. a fox runs,\nthe red fox sat; w w w , red fox red . end"
    got = one(spark, sentence_snippet(F.lit(text), F.lit("red fox")))
    # Scores 23, 22, 1, 0, 0: 20 x the rarer word plus all counts, equal ones in text order.
    assert got == ("...  <b>red</b> <b>fox</b> <b>red</b>  ... the <b>red</b> <b>fox</b> sat ...  a <b>fox</b> runs"
                   " ... none here ...  ...")
    assert one(spark, sentence_snippet(F.lit(",.;"), F.lit("x"))) == "...  ..."
    assert one(spark, sentence_snippet(F.lit(""), F.lit("x"))) == "...  ..."


def test_fragments(spark):
    text = "start " + "filler " * 30 + "red fox " + "filler " * 30 + "fox end"
    rows = spark.createDataFrame([(1, 1, "red fox", text), (1, 2, "red fox", "nothing")],
                                 "query_id bigint, doc_id bigint, keyword string, content string")
    got = fragment_snippets(rows).collect()
    assert [r.doc_id for r in got] == [1]
    first, second = got[0].snippet.removeprefix("... ").removesuffix(" ...").split(" ... ")
    assert "<B>red</B> <B>fox</B>" in first and second.rstrip().endswith("<B>fox</B> end")


def test_pages_cover_the_result(spark):
    results = spark.range(1, 24).select(F.lit(1).alias("query_id"), F.col("id").alias("rn"))
    hits = spark.createDataFrame([(1, 23), (2, 0)], "query_id int, hits bigint")
    wanted = spark.createDataFrame([(1, p) for p in range(3)] + [(2, 0)], "query_id int, page int")
    rows = paginate(results, hits, wanted).collect()
    assert sorted(r.rn for r in rows) == list(range(1, 24)) and {r.total_pages for r in rows} == {3}
    for asked, shown in ((-4, 1), (99, 3)):
        far = paginate(results, hits, spark.createDataFrame([(1, asked)], "query_id int, page int")).collect()
        assert {r.page_no for r in far} == {shown}


def test_requests(spark):
    cases = {
        "method=text&keyword=thanea+ther&page=1": ("text", "thanea ther", 0, None),
        "method=TextRank&keyword=thanea%20ther": ("textrank", "thanea ther", -1, None),
        "method=boolean&keyword=anea&page=x": ("boolean", "anea", 0, None),
        "keyword=a": (None, None, None, "Parameter `method` missing."),
        "method=foo&keyword=a": (None, None, None, bad_method(METHODS)),
        "method=text": (None, None, None, "Parameter `keyword` missing."),
        "method=text&keyword=a=b": (None, None, None, "Parameter `keyword` missing."),
        "method=text&keyword=a&keyword=b": (None, None, None, "Repeated parameter."),
        "method=text&keyword=%20": (None, None, None, "Parameter `keyword` missing."),
        "method=text&keyword=%zz&x": (None, None, None, "Parameter `keyword` missing."),
        None: (None, None, None, "Empty request"),
    }
    raw = spark.createDataFrame([(r,) for r in cases], "raw string")
    got = {r.raw: (r.method, r.keyword, r.page, r.error) for r in parse_requests(raw).collect()}
    assert got == cases


def test_json_pointer(spark):
    doc = json.dumps({"a/b": [1, {"k": "v"}], "0": {"x~y": True}, "n": None})
    cases = {"/a~1b/1/k": "v", "#/a~1b/0": "1", "/0/x~0y": "true", "/a~1b/7": None, "/missing": None, "/n": None, "": doc, "/*": None}
    for pointer, expected in cases.items():
        assert one(spark, json_pointer(F.lit(doc), pointer)) == expected
    odd = json.dumps({"*": 2, "": 4, "it's": [[1, [5]], {"0": "z"}]})
    for pointer, expected in {"/*": "2", "/": "4", "/it's/0/1/0": "5", "/it's/1/0": "z", "/it's/01": None}.items():
        assert one(spark, json_pointer(F.lit(odd), pointer)) == expected


def fragments_by_word(text, keyword, chars):
    """Windows from one word to the next, as plainly as they are defined."""
    words = {w.lower() for w in keyword.split(" ") if w}
    windows, at = {}, 0
    for piece in re.findall(r"[^a-zA-Z0-9éİ]*[a-zA-Z0-9éİ]+", text):
        lead, bare = re.fullmatch(r"([^a-zA-Z0-9éİ]*)(.*)", piece, re.S).groups()
        at += len(piece)
        line, hit = windows.setdefault(at // chars, ([], set()))
        line.append(f"{lead}<B>{bare}</B>" if bare.lower() in words else piece)
        hit |= {bare.lower()} & words
    best = sorted((-len(hit), k, "".join(line)) for k, (line, hit) in windows.items() if hit)[:5]
    return "... " + " ... ".join(re.sub("[ ]+", " ", re.sub("\r\n|\r|\n", " ", b[2])) for b in best) + " ..." if best else None


def test_fragments_against_words(spark):
    rng = random.Random(2)
    words = ["fox", "FOX", "foxes", "x1", "é", "É", "İx", "a" * 60, "filler"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "  ", "$1 "]) for _ in range(rng.randrange(50))) for _ in range(300)]
    rows = [(t.replace("É", "é"), rng.choice(["fox", "é x1", "fox, İx fox", "X1 filler FOX", "zz", "$1", ""])) for t in texts]
    for chars in (100, 9):
        got = spark.createDataFrame(rows, "t string, k string").select("t", "k", fragment_snippet(F.col("t"), F.col("k"), chars).alias("s")).collect()
        assert [r.s for r in got] == [fragments_by_word(r.t, r.k, chars) for r in got]


def test_fragments_take_a_few_passes_over_the_text(spark):
    rows = spark.range(0, 400, 1, 8).select(F.repeat(F.concat(F.lit("some filler words of text with a fox and more of it "), F.col("id").cast("string"), F.lit(" ")), 300).alias("t")).cache()
    rows.count()

    def took(column):
        best = []
        for _ in range(2):
            start = time.perf_counter()
            rows.select(column.alias("c")).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    cut = took(F.size(F.regexp_extract_all("t", F.lit(r"[^\p{L}\p{N}]*[\p{L}\p{N}]+"), F.lit(0))))
    assert took(fragment_snippet(F.col("t"), F.lit("fox la"))) < 8 * cut


def test_sentence_scores_of_the_helper():
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice(["a", "b", "A", "ab", "x", " ", " ", "  "]) for _ in range(rng.randrange(40)))
        query = rng.choice(["a", "a b", "a a ab", "x b a", "b", ""]).split()
        n = [counted(text, w) for w in query]
        assert sentence_score(text.lower().encode(), {w.encode(): query.count(w) for w in query}) == 20 * min(n, default=0) + sum(n), (text, query)


def test_marking_a_page_takes_little_more_than_cutting_its_texts(spark):
    words = " ".join(f"word{i}" for i in range(60))
    text = F.repeat(F.concat(F.lit("Some filler, of word7 with a word8 fox; and word9 more of it, "), F.col("id").cast("string"), F.lit(". ")), 120)
    rows = spark.range(0, 2000, 1, 4).select(text.alias("t")).cache()
    rows.count()

    def took(*columns):
        best = []
        for _ in range(3):
            start = time.perf_counter()
            rows.select(*columns).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    cut = took(F.size(F.regexp_extract_all("t", F.lit("[^ ]+"), F.lit(0))))
    assert took(sentence_snippet(F.col("t"), F.lit(words)), highlight(F.col("t"), F.lit(words), "span").alias("h")) < 4 * cut
