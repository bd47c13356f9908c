import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import CORPUS
from rankloom.plans import batch_search, build_index as building
from rankloom.plans.batch_search import answer_requests
from rankloom.plans.build_index import build_index
from rankloom.session import materialise, shared_dir, temporary_tables

LINKS = {"red fox": ["fox red", "blue whale"], "fox red": ["blue whale"], "blue whale": ["red fox"],
         "red panda": ["blue whale", "green tea", "unknown"]}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = [(i, t, c, k, LINKS.get(t, [])) for i, t, c, k in CORPUS]
    rows += [(50, "red fox", "a later page of the same title", ["x"], []), (51, "empty", "", ["x"], [])]
    pages = spark.createDataFrame(
        rows, "arrival bigint, title string, content string, categories array<string>, out_links array<string>"
    ).withColumn("last_modify", F.lit("2018-01-18 21:30:00").cast("timestamp_ntz"))
    return build_index(pages, str(tmp_path_factory.mktemp("index")), arrival="arrival", term_buckets=4, rank_epsilon=1e-2)


def responses(spark, index, raws):
    log = spark.createDataFrame(list(enumerate(raws)), "query_id bigint, raw string")
    return {r.query_id: json.loads(r.response) for r in answer_requests(index, log).collect()}


def test_tables(index):
    documents = {r.title: r.doc_id for r in index.table("documents").collect()}
    assert documents == {t: i for i, t in enumerate(sorted(t for _, t, _, _ in CORPUS))}
    assert index.table("page_rank").count() == 5
    assert index.search_tables().buckets == 4


def test_responses(spark, index):
    found = responses(spark, index, [
        "method=text&keyword=red+foxes", "method=textrank&keyword=red+fox", "method=boolean&keyword=red+fox&page=9",
        "method=text&keyword=zzzz", "method=nope&keyword=a"])
    assert [found[k]["error"] for k in range(5)] == [False] * 4 + [True]
    found = {k: r if r["error"] else r["data"] for k, r in found.items()}
    first = found[0]
    assert (first["hits"], first["pageNo"], first["totalPages"]) == (4, 1, 1)
    assert first["pages"][0]["url"].endswith("/red_fox") and first["pages"][0]["title"] == "<span>red</span> fox"
    assert first["pages"][0]["lastModify"] == "2018-01-18 21:30" and first["pages"][0]["score"] == "1.10723264"
    assert first["pages"][0]["categories"]["html"] == ["wild animal"]
    assert first["pages"][0]["categories"]["href"] == ["https://en.wikipedia.org/wiki/Category:wild_animal"]
    assert "Normalized PageRank" in found[1]["pages"][0]["score"] and found[1]["hits"] == 4
    assert found[2]["pageNo"] == 1 and "<B>red</B>" in found[2]["pages"][0]["snippet"]
    assert found[3] == {"hits": 0}
    assert found[4]["error"] is True and "Invalid" in found[4]["data"]


def test_hot_request_is_answered_for_everyone(spark, index):
    hot = "method=text&keyword=tea"
    raws = [hot if i % 3 else f"method=text&keyword=red+{i}" for i in range(60)]
    found = responses(spark, index, raws)
    assert len(found) == 60
    assert len({json.dumps(found[i], sort_keys=True) for i, r in enumerate(raws) if r == hot}) == 1
    assert found[1]["data"]["hits"] == 2 and found[0]["data"]["hits"] == 4


def test_a_log_leaves_requests_and_responses_alone_also_in_portions(spark, index, monkeypatch):
    raws = ["method=text&keyword=red+fox", "method=text&keyword=tea", "method=text&keyword=zzzz", "method=x&keyword=a", "method=text&keyword=red+fox&page=7"]
    log = spark.createDataFrame(list(enumerate(raws)), "query_id bigint, raw string")
    before = set(os.listdir(shared_dir(spark)))
    whole = sorted(answer_requests(index, log, methods={"text": "text"}).collect())
    left = {name.rpartition("-")[0] for name in set(os.listdir(shared_dir(spark))) - before}
    assert len(whole) == 5 and left == {"requests", "asked", "hits", "shown", "responses"}
    monkeypatch.setattr(batch_search, "SHOWN_ROWS", 3)
    assert sorted(answer_requests(index, log, methods={"text": "text"}).collect()) == whole


def test_postings_in_parts(spark, index, tmp_path, monkeypatch):
    monkeypatch.setattr(building, "PART_CHARS", 4)
    docs = index.table("documents")
    building.publish_primary(docs, index.table("doc_lengths"), str(tmp_path), True, 4)
    building.publish_standard(docs, str(tmp_path), 4)
    for analyzer in ("primary", "standard"):
        for table in ("postings", "term_stats", "field_stats"):
            got, want = spark.read.parquet(f"{tmp_path}/{analyzer}/{table}"), index.table(f"{analyzer}/{table}")
            assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(4, "k")
    materialise(rows, "rows")
    for _ in range(50):  # block managers are told to drop them
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_temporary_tables(spark):
    def there(df):
        return os.path.exists(df.inputFiles()[0].removeprefix("file:"))

    with temporary_tables(spark):
        with temporary_tables(spark):
            gone, kept = materialise(spark.range(3), "gone"), materialise(spark.range(4), "kept", kept=True)
        assert kept.count() == 4 and not there(gone) and there(kept)
    assert not there(kept)
