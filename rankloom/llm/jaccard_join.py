"""Near-duplicate groups by an exact Jaccard join of shingle sets: size-aware, light sets and heavy sets apart.

Equal sets are one node from the start. Light (small) nodes list their subsets of each size that a link can share: two
light sets that hold the same such subset are linked, so one member of a bucket can stand for the pairs of all of it.
Heavy nodes scan inverted lists of the rarest shingles of their sets (as many as two linked sets can't both miss). The
size that parts light from heavy is where subsets begin to cost more than lists.

A list of N nodes is never turned into all pairs. Every member is first compared with the most typical one, whose
shingles are the commonest, and members that are then connected need nothing more. Members of short lists that are still
apart are compared with each other. In long lists members are described by how they differ from the typical one: two of them can only be linked if both
differences are small, which makes them connected already, or share rare enough shingles, which an inverted list over
differences finds. No cap, sample or estimate decides on a pair: each candidate is checked on the whole sets.

What is broadcast has a fixed size whatever the input: a bit table of shingles that occur twice, and counts of the most
frequent ones. Both only order and thin the lists.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import cut as small_batches
from rankloom.llm.common import join_hot, join_salted, shingle_sets
from rankloom.llm.components import components
from rankloom.session import materialise

_TABLE_BITS = 26
_COUNTED = 1 << 20
#: Shingles gathered before they are sent by part.
_GATHERED = 1 << 18
#: Shared shingles that a pair must show among the rarest ones of both sets before whole sets are compared.
_SHOWN = 9
#: Sets larger than this are never light.
_LIGHT_MOST = 24
#: Lists with more nodes are long.
LONG_LIST = 64


def _least_partner(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _kept(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` that a linked set can't all miss."""
    return n - _least_partner(n, percent) + 1


def _overlap(n: int, m: int, percent: int) -> int:
    return -(-percent * (n + m) // (100 + percent))


def subset_sizes(n: int, percent: int) -> range:
    """Sizes of subsets that a set of ``n`` can share with a linked set."""
    return range(_overlap(n, _least_partner(n, percent), percent), n + 1)


def shingle_frequencies(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(bit table of shingles in two or more sets by part, frequent shingles, their counts, number of parts).

    Sets are sent as packed bytes by shingle, 4 bytes each, and counted part by part.
    """
    spark = docs.sparkSession
    parts = 1 << max(8, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    mask = (parts << 32) - 1
    own_bits, most = (1 << _TABLE_BITS) // parts, max(1, _COUNTED // parts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            seen, sets, size = set(), [], 0
            for found in itertools.chain(shingle_sets(batch.column(0), width), [None]):
                if found is not None and (digest := xxhash.xxh3_128_digest(found.tobytes())) not in seen:
                    seen.add(digest)
                    sets.append(found)
                    size += len(found)
                if size > _GATHERED or (found is None and size):
                    codes = np.concatenate(sets)
                    part = (codes & np.uint64(parts - 1)).astype(np.int32)
                    order = np.argsort(part, kind="stable")
                    rest = ((codes[order] & np.uint64(mask)) // np.uint64(parts)).astype("<u4")
                    ends = np.searchsorted(part[order], np.arange(parts + 1))
                    filled = np.flatnonzero(np.diff(ends))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(filled.astype(np.int32)), pa.array([rest[ends[p] : ends[p + 1]].tobytes() for p in filled], pa.binary())], ["part", "codes"])
                    sets, size = [], 0

    def count(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        codes, n = np.unique(np.concatenate([np.frombuffer(b, "<u4") for b in group.column("codes").to_pylist()]), return_counts=True)
        codes, n = codes[n > 1], n[n > 1]
        bits = np.zeros(own_bits, bool)
        bits[codes % own_bits] = True
        top = np.argsort(-n, kind="stable")[:most]
        top = top[n[top] > 2]
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
                         "codes": pa.array([codes[top].astype("<u4").tobytes()], pa.binary()), "counts": pa.array([n[top].astype("<u4").tobytes()], pa.binary())})

    sent = docs.select("text").mapInArrow(send, "part int, codes binary")
    rows = sent.groupBy("part").applyInArrow(count, "part int, bits binary, codes binary, counts binary").collect()  # as many rows as parts, of fixed size
    table = np.zeros((parts, own_bits // 8), np.uint8)
    codes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for r in rows:
        table[r.part] = np.frombuffer(r.bits, np.uint8)
        codes.append(np.frombuffer(r.codes, "<u4").astype(np.uint64) * np.uint64(parts) + np.uint64(r.part))
        counts.append(np.frombuffer(r.counts, "<u4").astype(np.int64))
    codes, counts = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(codes)
    return table.ravel(), codes[order], counts[order], parts


class _Order:
    """Ranks of shingles, rare first; the same for all sets."""

    def __init__(self, frequencies: tuple[np.ndarray, np.ndarray, np.ndarray, int]):
        self.bits, self.codes, self.counts, self.parts = frequencies

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """0: in one set; 1: in a few; else the number of sets."""
        own_bits = (1 << _TABLE_BITS) // self.parts
        part = (shingles & np.uint64(self.parts - 1)).astype(np.int64)
        at = part * own_bits + (shingles // np.uint64(self.parts) & np.uint64(own_bits - 1)).astype(np.int64)
        weight = ((self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(np.int64)
        if len(self.codes):
            code = shingles & np.uint64((self.parts << 32) - 1)
            k = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            weight = np.where(self.codes[k] == code, self.counts[k], weight)
        return weight


def _longs(a: np.ndarray) -> list[int]:
    return a.astype(np.uint64).view(np.int64).tolist()


def shingle_rows(docs: DataFrame, width: int, percent: int, order: Broadcast) -> DataFrame:
    """doc_id, n, digest of the set, and its rare shingles that occur elsewhere: ``prefix`` for the lists, ``shown`` to
    compare before whole sets are; ``small`` has the whole set where it may be light, and ``typical`` says how common its
    shingles are: high for the original of a group, low for a member of it with many changes."""
    schema = "doc_id long, text_hash long, n long, digest binary, typical double, prefix array<long>, shown array<long>, small array<long>"
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n, digest, typical, prefix, shown, small = [], [], [], [], [], []
            for found in shingle_sets(batch.column(2), width):
                weight = order.value.weights(found)
                rank = np.lexsort((found, weight))
                most = _kept(len(found), percent)
                cut = lambda k: _longs(found[rank[:k]][weight[rank[:k]] > 0])  # noqa: B023, E731
                n.append(len(found))
                digest.append(xxhash.xxh3_128_digest(found.tobytes()))
                typical.append(float(np.log2(1.0 + weight).sum() / max(1, len(found))))
                prefix.append(cut(most))
                shown.append(cut(most + _SHOWN - 1))
                small.append(_longs(found) if len(found) <= _LIGHT_MOST else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(typical, pa.float64()), pa.array(prefix, longs), pa.array(shown, longs), pa.array(small, longs)],
                ["doc_id", "text_hash", "n", "digest", "typical", "prefix", "shown", "small"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def light_links(nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all linked light nodes: members of a bucket with its smallest set.

    If two members of a bucket are linked by its subset's size, both are linked to the smallest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for node, small in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = [(size, xxhash.xxh3_64_intdigest(np.array(s, np.int64).tobytes()) - (1 << 63)) for size in subset_sizes(len(small), percent) for s in itertools.combinations(small, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node] * len(keys), pa.int64()), pa.array([len(small)] * len(keys), pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())],
                    ["node", "n", "size", "subset"])

    rows = nodes.select("node", "small").mapInArrow(run, "node long, n long, size long, subset long")
    buckets = materialise(rows.groupBy("size", "subset").agg(F.min(F.struct("n", "node")).alias("s"), F.count("*").alias("many")).filter("many > 1"), "buckets")
    fits = F.expr(f"{percent} * (n + s.n) <= {100 + percent} * size")
    return join_hot(rows, buckets, ["size", "subset"], "many").filter(fits & (F.col("node") != F.col("s.node"))).select(F.col("s.node").alias("a"), F.col("node").alias("b")).distinct()


def light_boundary(costs: dict[int, tuple[int, int]], percent: int) -> int:
    """Largest light size: where subsets up to it and lists beyond it cost least. costs: nodes and list work by size."""
    best, at, total = 0, 0, 0
    for n in range(1, _LIGHT_MOST + 1):
        nodes, work = costs.get(n, (0, 0))
        total += nodes * sum(comb(n, size) for size in subset_sizes(n, percent)) - work
        if total <= best:
            best, at = total, n
    return at


def _sized(percent: int, a: str = "n_a", b: str = "n_b"):
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _ends(pairs: DataFrame) -> DataFrame:
    """Pairs of each a: many of them where a is the pivot of long lists."""
    return materialise(pairs.groupBy("a").agg(F.count("*").alias("many")), "ends")


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sizes that fit which share enough of their rare shingles. ``pairs`` should be a written table."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shown").alias(f"shown_{x}"))
    both = join_salted(pairs.join(side("b"), "b"), side("a"), ["a"], _ends(pairs)).filter(_sized(percent))
    need = F.expr(f"least({_SHOWN}, ceil({percent} * (n_a + n_b) / {100 + percent}.0))")
    return both.filter(F.size(F.array_intersect("shown_a", "shown_b")) >= need).select("a", "b")


def whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node and its packed set for the nodes in ``wanted`` (node, doc_id, text_hash, digest).

    Texts are found by id and hash, so rows with the same id (or none) and other texts don't meet; equal rows become one first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            node, own = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            kept = [(i, found.tobytes()) for i, d, found in zip(node, own, shingle_sets(batch.column(2), width), strict=True) if xxhash.xxh3_128_digest(found.tobytes()) == d]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.binary())], ["node", "shingles"])

    texts = docs.groupBy(F.col("doc_id").cast("long").alias("_doc_id"), F.xxhash64("text").alias("_text_hash")).agg(F.first("text").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    return wanted.join(texts, same).select("node", "digest", "text").mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _linked(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            good = [k for k in range(len(a)) if _linked(x[k], y[k], percent)]
            yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in good], pa.int64()), pa.array([b[k] for k in good], pa.int64())], ["a", "b"])

    side = lambda n, s: sets.select(F.col("node").alias(n), F.col("shingles").alias(s))
    both = join_salted(pairs.join(side("b", "y"), "b"), side("a", "x"), ["a"], _ends(pairs))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def difference_rows(members: DataFrame, sets: DataFrame, percent: int, order: Broadcast) -> DataFrame:
    """Members (pivot, node) of long lists by what they differ in: n, d (size of the difference) and, one row each, the
    shingles of the difference that two linked members can't both miss, rare first and those of the pivot last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: list[list] = [[], [], [], [], [], []]
            for pivot, node, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                p, own = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                more, less = np.setdiff1d(own, p, assume_unique=True), np.setdiff1d(p, own, assume_unique=True)
                weight = order.value.weights(more)
                ranked = np.concatenate([more[np.lexsort((more, weight))], less])
                alone = int((weight == 0).sum())  # in no other set, and first in order
                # Two linked sets differ by at most (100 - percent) % of their union, and that is at most n / percent %.
                apart = (100 - percent) * len(own) // percent
                most = len(ranked) - max(1, len(ranked) - apart) + 1
                useful = list(range(alone, max(alone, min(most, len(ranked)))))
                for values, column in zip(([pivot] * len(useful), [node] * len(useful), [len(own)] * len(useful), [len(ranked)] * len(useful), useful, _longs(ranked[useful])), out, strict=True):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["pivot", "node", "n", "d", "k", "shingle"])

    side = lambda n, s: sets.select(F.col("node").alias(n), F.col("shingles").alias(s))
    many = materialise(members.groupBy("pivot").agg(F.count("*").alias("many")), "pivots")
    both = join_salted(members.join(side("node", "y"), "node"), side("pivot", "x"), ["pivot"], many)
    return both.select("pivot", "node", "x", "y").mapInArrow(run, "pivot long, node long, n long, d long, k long, shingle long")


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose ends aren't in one component yet."""
    side = lambda x: known.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return joined.filter(~(F.col("c_a").isNotNull() & F.col("c_a").eqNullSafe(F.col("c_b")))).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 85, long_list: int = LONG_LIST) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs``.

    Shingles are ``width`` words in a row; a text with fewer words is one shingle; texts without words, null ones too,
    are linked with nothing. Sets are linked when ``100 * intersection >= percent * union``. component_id is the smallest
    doc_id reachable over links. Rows that share a doc_id are rows of their own with their own sets; a row whose doc_id is
    null has the component of its group, or null. ``docs`` is read several times and should be a table.
    """
    order = docs.sparkSession.sparkContext.broadcast(_Order(shingle_frequencies(docs, width)))
    rows = materialise(shingle_rows(docs, width, percent, order), "shingles")
    filled = rows.filter("n > 0")
    source = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = materialise(filled.groupBy("digest").agg(
        F.min(source)["doc_id"].alias("doc_id"), F.min(source)["text_hash"].alias("text_hash"), F.first("n").alias("n"), F.first("typical").alias("typical"), F.first("prefix").alias("prefix"), F.first("shown").alias("shown"), F.first("small").alias("small"),
    ).withColumn("node", F.monotonically_increasing_id()), "nodes")

    # Lists of two or more nodes.
    postings = nodes.select("node", "n", "typical", F.explode("prefix").alias("shingle"))
    lists = materialise(postings.groupBy("shingle").agg(
        F.max(F.struct("typical", "node"))["node"].alias("pivot"), F.count("*").alias("many"), F.max("n").alias("longest")).filter("many > 1"), "lists")
    listed = materialise(join_hot(postings.drop("typical"), lists.withColumn("length", F.col("many")), ["shingle"], "many"), "listed")
    costs = {r.n: (r.nodes, r.work) for r in nodes.filter(F.col("n") <= _LIGHT_MOST).groupBy("n").agg(F.count("*").alias("nodes")).join(
        listed.filter(F.col("n") <= _LIGHT_MOST).groupBy("n").agg(F.sum("length").alias("work")), "n", "left").fillna(0).collect()}
    light = light_boundary(costs, percent)
    links = [light_links(nodes.filter(F.col("n") <= light), percent)]
    heavy = listed.filter(F.col("longest") > light)

    # Everyone against the most typical node of each list.
    star = heavy.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    star = materialise(star, "star-candidates")
    star = materialise(_plausible(star, nodes, percent), "star")
    long_members = materialise(heavy.filter(F.col("length") > long_list).select("pivot", "node").distinct(), "members")
    keys = nodes.select("node", "doc_id", "text_hash", "digest")
    ends = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node"))).unionByName(long_members.select("node"))
    sets = materialise(whole_sets(docs, keys.join(ends.distinct(), "node"), width), "sets")
    links.append(verified(star, sets, percent))
    first = materialise(links[0].unionByName(links[1]), "links")
    known = materialise(components(first), "components")

    # Members of short lists that are still apart.
    short = heavy.filter(F.col("length").between(3, long_list)).join(known, "node", "left").select("shingle", "node", "n", F.coalesce("component", "node").alias("c"))
    mixed = short.groupBy("shingle").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("shingle")
    short = short.join(mixed, "shingle")
    x, y = short.select("shingle", *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "c"))), short.select("shingle", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "c")))
    rest = x.join(y, "shingle").filter(F.expr("node_a < node_b and c_a <> c_b") & _sized(percent)).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    rest = _plausible(materialise(rest.join(star, ["a", "b"], "left_anti"), "short-candidates"), nodes, percent)

    # Members of long lists, by their differences.
    differing = difference_rows(long_members, sets, percent, order).join(known, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    differing = materialise(differing, "differences")
    shared = differing.groupBy("pivot", "shingle").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("pivot", "shingle")
    differing = differing.join(shared, ["pivot", "shingle"])
    x, y = (differing.select("pivot", "shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "d", "k", "c"))) for s in "ab")
    # With this overlap of their differences sets can be linked; behind places k_a and k_b so much is left.
    need = f"ceil((d_a + d_b - floor({100 - percent} * (n_a + n_b) / {100 + percent}.0)) / 2.0)"
    apart = x.join(y, ["pivot", "shingle"]).filter(
        F.expr(f"node_a < node_b and c_a <> c_b and least(d_a - k_a, d_b - k_b) >= {need}") & _sized(percent)).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    apart = apart.join(star, ["a", "b"], "left_anti")
    rest = materialise(rest.unionByName(apart).distinct(), "rest")
    ends = rest.select(F.col("a").alias("node")).unionByName(rest.select(F.col("b").alias("node"))).distinct().join(sets.select("node"), "node", "left_anti")
    sets = sets.unionByName(materialise(whole_sets(docs, keys.join(ends, "node"), width), "sets"))

    # These links join components found before, not single nodes.
    late = verified(rest, sets, percent)
    for end in "ab":
        late = late.join(known.select(F.col("node").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    merged = components(late).select(F.col("node").alias("c"), F.col("component").alias("into"))

    # Back to documents: the smallest doc_id of a component.
    node_of = nodes.select("node", "digest", "doc_id").join(known, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    node_of = node_of.join(merged, "c", "left").withColumn("component", F.coalesce("into", "c")).select("node", "digest", "doc_id", "component")
    smallest = materialise(node_of.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("nodes")), "smallest")
    named = join_hot(node_of.select("digest", "component"), smallest, ["component"], "nodes").select("digest", "component_id")
    copies = filled.groupBy("digest").agg(F.count("*").alias("copies"))
    named = materialise(named.join(copies, "digest"), "named")
    order.destroy()  # all that needs it is written
    linked = join_hot(filled.select("doc_id", "n", "digest"), named, ["digest"], "copies").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
