import random

from pyspark.sql import functions as F

from rankloom.operators.dedupe import first_wins, new_rows
from rankloom.operators.ids import even_split, split_size, with_dense_index
from rankloom.operators.scan import running_last


def test_dense_index(spark):
    titles = [f"t{i:05d}" for i in range(1000)]
    random.Random(1).shuffle(titles)
    rows = with_dense_index(spark.createDataFrame([(t,) for t in titles], "title string"), ["title"], "i").collect()
    assert {r.title: r.i for r in rows} == {t: i for i, t in enumerate(sorted(titles))}


def test_dense_index_of_nothing(spark):
    assert with_dense_index(spark.createDataFrame([], "title string"), ["title"]).isEmpty()


def test_even_split(spark):
    for rows, workers in ((23, 5), (20, 5), (3, 5)):
        counts = even_split(spark.range(rows), "id", rows, workers).groupBy("worker").count().collect()
        expected = {w: split_size(rows, workers, w) for w in range(workers)}
        assert dict(counts) == {w: n for w, n in expected.items() if n}


def test_first_wins_with_a_hot_title(spark):
    rows = [("hot" if i % 3 == 0 else f"t{i}", 1000 - i) for i in range(900)]
    kept = first_wins(spark.createDataFrame(rows, "title string, arrival bigint").repartition(6), ["title"], ["arrival"])
    best = {}
    for title, arrival in rows:
        best[title] = min(arrival, best.get(title, arrival))
    assert dict(kept.collect()) == best


def test_new_rows(spark):
    stored = spark.createDataFrame([("a", 0)], "title string, arrival bigint")
    arriving = spark.createDataFrame([("a", 5), ("b", 7), ("b", 6)], "title string, arrival bigint")
    assert new_rows(arriving, stored, ["title"], ["arrival"]).collect() == [("b", 6)]


def test_running_last_over_chunks(spark):
    rng, rows, expected = random.Random(2), [], {}
    for host in ("hot", "cold", "empty"):
        last = None
        for n in range(300 if host == "hot" else 20):
            value = f"v{n}" if host != "empty" and rng.random() < 0.1 else None
            last = value or last
            rows.append((host, n, value))
            expected[host, n] = last
    df = spark.createDataFrame(rows, "host string, n bigint, v string").repartition(5)
    found = running_last(df, "host", "n", F.col("v"), "last", chunk=16).collect()
    assert {(r.host, r.n): r["last"] for r in found} == expected
