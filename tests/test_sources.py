import pytest
from pyspark.sql import functions as F

from rankloom.operators import postings as po
from rankloom.plans.build_index import current_index, rebuild_index
from rankloom.sources import interchange, jsonl, serving, tables
from rankloom.streaming import ingest


def test_posting_line_format(docs):
    lines = {r.line for r in interchange.posting_lines(po.postings(docs)).collect()}
    assert "fox\t0:1,1,0|1,2;1:1,1,0|0,1;6:1,0,0|1" in lines


def test_posting_lines_round_trip(docs):
    posted = po.postings(docs)
    for block in (65_536, 2):
        back = interchange.parse_posting_lines(interchange.posting_lines(posted, block))
        assert sorted(back.collect()) == sorted(posted.select(*back.columns).collect())


def test_rank_lines(spark):
    ranks = spark.createDataFrame([(0, 0.25), (1, 1e-7)], "doc_id bigint, rank double")
    listed = spark.createDataFrame([(0, [1, 2])], "id bigint, links array<bigint>")
    lines = interchange.rank_lines(ranks, listed)
    assert "0,0.25\t1,2" in {r.line for r in lines.collect()}
    assert sorted(interchange.parse_rank_lines(lines).collect()) == sorted(ranks.collect())


def test_json_lines_set_bad_ones_aside(spark, tmp_path):
    good = '{"id": 1, "title": "t", "content": "c", "categories": ["x"]}'
    bad = [good[:-9], '{"id": 2, "title": "t"}', "[1]", "text"]
    (tmp_path / "part.json").write_text("\n".join([good, "", *bad, "  ", ""]))
    kept, aside = jsonl.read_lines(spark, str(tmp_path), jsonl.DOCUMENTS)
    assert kept.collect() == [(1, "t", "c", ["x"])]
    assert {r.value for r in aside.collect()} == set(bad)


def test_page_table(spark, tmp_path):
    name = "lifecycle_pages"
    with pytest.raises(tables.MissingTable):
        tables.open_table(spark, name)
    for _ in range(2):
        tables.create_page_table(spark, name, str(tmp_path / "pages"))
    empty = tables.open_table(spark, name)
    assert tables.page_count(empty).first().is_empty
    text = spark.createDataFrame([("t", "c", "a|b|", "2018-01-18 21:30", "")],
                                 "title string, content string, categories string, lastModify string, outLinks string")
    tables.from_text_columns(text).write.insertInto(name)
    row = tables.to_text_columns(tables.open_table(spark, name)).first()
    assert tuple(row) == ("t", "c", "a|b", "2018-01-18 21:30", "")
    with pytest.raises(tables.MissingTable):
        tables.checked(text, ["nope"])
    spark.sql(f"DROP TABLE {name}")


def test_published_postings(spark, docs, tmp_path):
    posted = po.postings(docs)
    serving.publish_postings(posted, str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert sorted(back.select(*posted.columns).collect()) == sorted(posted.collect())


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"t{i % 40}", "" if i % 11 == 0 else f"c{i}", ["x"]) for i in range(120)]
    schema = "arrival bigint, title string, content string, categories array<string>"
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    for start in range(0, 120, 30):
        spark.createDataFrame(rows[start:start + 30], schema).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.page_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
        query = ingest.ingest(stream, target, marks, "arrival")
        query.awaitTermination()
    counted = ingest.progress(spark, target).orderBy(ingest.BATCH).collect()
    assert [r.n_arrived for r in counted] == [30] * 4 and counted[-1].n_total == 40
    first = {}
    for arrival, title, content, _ in rows:
        if content:
            first.setdefault(title, arrival)
    stored = spark.read.parquet(target)
    assert {r.title: r.arrival for r in stored.collect()} == first


def test_repeated_batch_replaces_itself(spark, tmp_path):
    batch = spark.createDataFrame([(0, "a", "x", ["c"]), (1, "b", "y", ["c"])],
                                  "arrival bigint, title string, content string, categories array<string>")
    target = str(tmp_path / "t")
    batch.limit(0).write.parquet(f"{target}/{ingest.BATCH}=-1")
    for batch_id in (0, 0, 1):
        ingest.insert_batch(batch, batch_id, target, "arrival")
    assert sorted(r.title for r in spark.read.parquet(target).collect()) == ["a", "b"]
    assert sorted(ingest.progress(spark, target).select(ingest.BATCH, "n_arrived", "n_inserted", "n_total").collect()) == [(0, 2, 2, 2), (1, 2, 0, 2)]


def test_failed_rebuild_leaves_the_published_index(spark, tmp_path):
    path = str(tmp_path / "index")
    pages = spark.createDataFrame([("red fox", "a red fox", ["c"])], "title string, content string, categories array<string>")
    options = {"stem": False, "standard": False, "ranks": False}

    def titles():
        return [r.title for r in current_index(spark, path).table("documents").orderBy("title").collect()]

    with pytest.raises(Exception):
        rebuild_index(pages.withColumn("content", F.raise_error("broken")), path, **options)
    with pytest.raises(LookupError):
        current_index(spark, path)
    old = rebuild_index(pages, path, **options)
    assert titles() == ["red fox"]
    with pytest.raises(Exception):
        rebuild_index(pages.withColumn("content", F.raise_error("broken")), path, **options)
    assert titles() == ["red fox"]
    rebuild_index(pages.withColumn("title", F.lit("blue whale")), path, **options)
    assert titles() == ["blue whale"] and old.table("primary/term_stats").filter("term = 'fox'").count() == 2


def test_incomplete_page_does_not_take_a_title(spark):
    from rankloom.plans.build_index import numbered_documents

    pages = spark.createDataFrame([("t", "", ["c"], 1), ("t", "text", ["c"], 2), ("t", "later", ["c"], 3)], "title string, content string, categories array<string>, arrival bigint")
    assert [(r.title, r.content) for r in numbered_documents(pages, "arrival").collect()] == [("t", "text")]


def test_postings_are_computed_once_when_published(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    posted = spark.range(1000).selectExpr("concat('t', id % 3) term", "1 field_id", "id doc_id", "1 tf").mapInArrow(
        counted, "term string, field_id int, doc_id long, tf int")
    serving.publish_postings(posted, str(tmp_path / "p"), 4)
    assert seen.value == spark.read.parquet(str(tmp_path / "p")).count() == 1000
