"""Exact search, prefix trie and periodic runs against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import exact_search, periodic_runs, prefix_trie
from rankloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def table_dir(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


# Exact search


def brute_top(rows, k):
    good = [(i, [math.floor(1024 * Fraction(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for query in sorted({i for i, _ in good if i % 100 == 0}):
        best = {}
        for qi, q in good:
            for i, v in good:
                if qi == query and i != query:
                    best[i] = max(best.get(i, -(1 << 63)), min((1 << 63) - 1, sum(a * b for a, b in zip(q, v))))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(query, n + 1, i, s) for n, (i, s) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("cells", [1 << 23, 64])
def test_exact_search_against_brute_force(spark, tmp_path, cells):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).astype(np.float32) * (rng.random(8) < 0.4)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # a common vector
    rows += [(5, rows[9][1]), (100, rows[3][1]), (100, rows[3][1]), (200, rows[200][1])]  # ids that repeat
    rows += [(None, [1.0] * 8), (901, None), (902, [None] * 8), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (500, [])]
    rows += [(905, [0.5, -0.5]), (906, [0.0] * 8), (907, [1.0] * 20)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, query_id string, rank int")
    use = exact_search.usable(df, "vec_id", "embedding")
    got = exact_search.top_k(use, use.filter("vec_id % 100 = 0"), shard_cells=cells, least_rows=50).orderBy("query_id", "rank")
    assert [tuple(r) for r in got.collect()] == brute_top(rows, 10)


def test_exact_search_of_large_components_and_few_rows(spark):
    rows = [(0, [1e6, 3.5]), (1, [1e6, 1.0]), (2, [-1e300, 2.0]), (3, [1e6, 1.0009765625]), (4, [1e301, 0.0]), (5, [1e300, 0.0])]
    df = exact_search.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = exact_search.top_k(df, df.filter("vec_id % 100 = 0"))
    assert [tuple(r) for r in got.orderBy("rank").collect()] == brute_top(rows, 10)
    assert exact_search.top_k(df.filter("vec_id = 9"), df.filter("vec_id = 9")).count() == 0
    assert exact_search.top_k(df.filter("vec_id = 0"), df.filter("vec_id = 0")).count() == 0


# Prefix trie


def turns_of(conversations):
    """Rebuilt sequences of the query, from rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in conversations:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def brute_trie(sequences):
    members = {}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node, own in members.items():
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in kids)
            saved[node[:d]] = saved.get(node[:d], 0) + ((len(own) - 1) * len(node[-1][1]) if node else 0)
    return sorted((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), kids.get(node, 0), leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(node)).encode()).hexdigest()) for node, own in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rng, n, longest):
    rows, common = [], [("user", f"c{k}") for k in range(longest)]
    for c in range(n):
        kind = rng.random()
        if kind < 0.3:
            seq = common[: rng.choice([3, longest])]
        elif kind < 0.6:
            seq = common[: rng.randrange(longest)] + [(rng.choice(["user", "assistant"]), rng.choice("ab")) for _ in range(rng.randrange(4))]
        else:
            seq = [(rng.choice(["user", None]), rng.choice(["a", "b", None, "", "long text é"])) for _ in range(rng.randrange(1, 6))]
        rows += [(c * 3 - 20, None if k == 0 and rng.random() < 0.2 else k * 2, *turn) for k, turn in enumerate(seq)]
    return rows


@pytest.mark.parametrize(("seed", "width", "shard_rows", "longest"), [(1, 16, 1 << 16, 9), (2, 2, 9, 9), (3, 3, 4, 40), (4, 1, 7, 7)])
def test_prefix_trie_against_brute_force(spark, seed, width, shard_rows, longest):
    rows = conversations(random.Random(seed), 120, longest) + [(None, 1, "user", "nobody's")]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, depth string, id1 int").repartition(4)
    conv = F.col("conv_id")
    turns = prefix_trie.rebuilt(prefix_trie.numbered_turns(df), conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, most=5)
    nodes, ends = prefix_trie.prefix_trie(turns, width=width, shard_rows=shard_rows, least_rows=shard_rows)
    sequences = turns_of(rows)
    assert sorted(ends.select("conv_id").toPandas()["conv_id"]) == sorted(sequences)
    got = [tuple(r) for r in prefix_trie.with_digests(nodes, ends).select(COLUMNS).collect()]
    assert sorted(got) == brute_trie(sequences)


def test_prefix_trie_of_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(100, k, "user", f"t{k}") for k in range(50)] + [(101, k, "user", f"t{k % 45}") for k in range(50)] + [(103, None, None, None)] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv = F.col("conv_id")
    turns = prefix_trie.rebuilt(prefix_trie.numbered_turns(df), conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, most=5)
    got = [tuple(r) for r in prefix_trie.with_digests(*prefix_trie.prefix_trie(turns, width=2, shard_rows=8, least_rows=8)).select(COLUMNS).collect()]
    assert sorted(got) == brute_trie(turns_of(rows))


def test_prefix_trie_query_on_small_and_empty_tables(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    assert QUERIES["op12_prefix_trie"](spark, table_dir(spark, tmp_path / "e", "conversations", [], schema)).count() == 0
    rows = conversations(random.Random(8), 60, 9)
    path = table_dir(spark, tmp_path / "s", "conversations", rows, schema)
    got = sorted(tuple(r) for r in QUERIES["op12_prefix_trie"](spark, path).select(COLUMNS).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet/*.parquet'")
    assert got == brute_trie(turns_of(rows)) == sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op12_prefix_trie']})").fetchall())


# Periodic runs


def brute_runs(w, least=6):
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 4 * q) and not any(all(w[k] == w[k + d] for k in range(i, j + q - d)) for d in range(1, q)):
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def words(text):
    return (text or "").encode().split()


def summary(doc_id, text):
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in dropped)).hexdigest())


def sample_words(rng):
    out = []
    for _ in range(rng.randrange(1, 5)):
        base = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 40))]
        if rng.random() < 0.5:
            base = base * rng.randrange(1, 6) + [rng.randrange(3) for _ in range(rng.randrange(3))]
        out += (base * rng.randrange(1, 8))[: rng.randrange(1, 300)]
    return out


def test_runs_of_many_texts_at_once():
    rng = random.Random(11)
    fibonacci, after = [0], [0, 1]
    for _ in range(10):
        fibonacci, after = after, after + fibonacci
    for _ in range(60):
        texts = [sample_words(rng) for _ in range(rng.randrange(1, 6))] + [[rng.randrange(2) for _ in range(100)], [], fibonacci]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        want = [(s + int(b), n, q) for b, t in zip(bounds, texts) for s, n, q in brute_runs(t, 0)]
        assert periodic_runs.find_runs(np.array([x for t in texts for x in t], dtype=np.int32), bounds) == sorted(want, key=lambda r: (r[0], r[2]))


def test_periodic_runs_query(spark, tmp_path):
    rng = random.Random(12)
    rows = [(k, rng.choice(" \t\n").join(f"wörd{x}" for x in sample_words(rng))) for k in range(300)]
    rows += [(None, "a a a a a a a"), (900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "a b " * 30), (904, "a b " * 30), (905, "nb sp " * 6), (906, " ".join(f"w{k}" for k in range(60_000)))]
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows) > 10
    path = table_dir(spark, tmp_path, "documents", [(i, t, "x", 1) for i, t in rows], "doc_id long, text string, runs string, start int")
    got = sorted((tuple(r) for r in QUERIES["op13_periodic_runs"](spark, path).collect()), key=repr)
    slow = [summary(i, t) for i, t in rows if i != 906]
    assert [r for r in got if r[0] != 906] == sorted(slow, key=repr)
    empty = table_dir(spark, tmp_path / "e", "documents", [], "doc_id long, text string")
    assert QUERIES["op13_periodic_runs"](spark, empty).count() == 0


def test_new_queries_cover_their_tables(spark):
    assert QUERIES["op13_periodic_runs"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
