"""Trie of the common beginnings of conversations.

A turn is known by a hash of 128 bits. Conversations are cut into segments of a fixed number of turns, so that no row
grows with a conversation, and equal segments after equal beginnings become one weighted row. Rows are dealt into shards
by range; a shard is a padded matrix of turn ids, sorted by lexsort. Changes from row to row, OR-accumulated over the
columns, mark where the nodes of each depth start, and reduceat sums up their members. Nodes on the first and the last
row's path of a shard, and those that a segment ends with, are recombined by their key.

Sums over subtrees are sums over members: a conversation is counted as a leaf by the smallest member of that leaf, and
tokens saved follow from how far each conversation shares its path with a smaller one, which the first of two passes finds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import join_hot, mix
from rankloom.operators.ids import with_dense_index
from rankloom.session import materialise

#: Turns of a segment, the width of a matrix.
WIDTH = 16
#: Rows of a shard on average, and the rows below which a shard isn't cut further.
SHARD_ROWS, LEAST_ROWS = 1 << 16, 4096
#: Segments of a conversation that are summed up in one window.
CHUNK = 4096
#: Conversation ids that are packed in one row.
PACK = 4096

_PAD = np.iinfo(np.int64).min
_KEY = ("k1", "k2", "j", "r1", "r2")
_PARENT = ("p1", "p2", "pj", "pr1", "pr2")
_RECORD = (
    "open boolean, k1 long, k2 long, j int, r1 long, r2 long, depth long, conv_id long, q long, n long, sum_q long, sum_leaf long, before long, "
    "children long, edge_children array<long>, p1 long, p2 long, pj int, pr1 long, pr2 long, parent_conv_id long, end1 long, end2 long"
)


# Sequences of turns.


def numbered_turns(df: DataFrame) -> DataFrame:
    """conv_id, index, id1, id2, n of all turns with a conv_id; index is dense and follows conv_id and turn.

    Null turns come first; turns with equal numbers follow the hash of their content. id1 and id2 are a hash of role and
    text, null being empty, and n counts the code points of the text. A conversation of any length is split among tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = df.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("id1"),
        F.xxhash64(F.lit(1), text, role).alias("id2"), F.length(text).cast("long").alias("n"))
    turns = turns.withColumn("place", F.monotonically_increasing_id())  # equal turns, too, can be split among tasks
    order = ["conv_id", F.col("turn").asc_nulls_first(), "id1", "id2", "place"]
    return with_dense_index(turns, order).drop("turn", "place")


def rebuilt(indexed: DataFrame, base: Column, borrowed: Column, most: int) -> DataFrame:
    """Sequences conv_id, pos, id1, id2, n, n_turns: the first ``borrowed`` turns of conversation ``base``, then the own ones after as many.

    ``base`` and ``borrowed`` are expressions of conv_id; ``most`` bounds ``borrowed``. All turns of the base are taken if it
    has fewer, none if there is no such conversation. A conversation that is left without turns has one row, of which pos is null.
    """
    sizes = materialise(indexed.groupBy("conv_id").agg(F.min("index").alias("start"), F.count("*").alias("turns")), "trie-sizes")
    cell = F.struct("index", "id1", "id2", "n")
    heads = (
        sizes.select(F.col("conv_id").alias("base"), F.explode(F.sequence("start", F.col("start") + F.least("turns", F.lit(most)) - 1)).alias("index"))
        .join(sizes.select(base.alias("base")).distinct(), "base").join(indexed.drop("conv_id"), "index")
        .groupBy("base").agg(F.sort_array(F.collect_list(cell)).alias("head"))
    )
    convs = (
        sizes.withColumn("base", base).withColumn("h", borrowed.cast("int")).join(heads, "base", "left")
        .withColumn("head", F.when(F.col("head").isNull() | (F.col("h") <= 0), F.array().cast("array<struct<index:bigint,id1:bigint,id2:bigint,n:bigint>>")).otherwise(F.slice("head", 1, F.greatest("h", F.lit(1)))))
        .withColumn("n_turns", F.size("head") + F.greatest(F.col("turns") - F.col("h"), F.lit(0)))
    )
    convs = materialise(convs.drop("base"), "trie-conversations")
    taken = convs.select("conv_id", "n_turns", F.posexplode_outer("head").alias("pos", "cell")).filter("pos is not null or n_turns = 0")
    taken = taken.select("conv_id", F.col("pos").cast("long").alias("pos"), "cell.id1", "cell.id2", "cell.n", "n_turns")
    own = join_hot(indexed, convs.withColumn("kept", F.size("head")).drop("head"), ["conv_id"], "turns").filter(F.col("index") - F.col("start") >= F.col("h"))
    own = own.select("conv_id", (F.col("index") - F.col("start") - F.col("h") + F.col("kept")).alias("pos"), "id1", "id2", "n", "n_turns")
    return taken.unionByName(own)


def segments(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per conversation and segment: its turn ids, the keys of the beginnings before it (root) and with it (tail), tokens before it."""
    seg = F.coalesce(F.floor(F.col("pos") / width), F.lit(0)).cast("long")
    cell = F.when(F.col("pos").isNotNull(), F.struct("pos", "id1", "id2", "n"))
    rows = turns.groupBy("conv_id", seg.alias("seg")).agg(F.sort_array(F.collect_list(cell)).alias("cells"), F.max("n_turns").alias("n_turns"))
    ids = F.transform("cells", lambda c: F.struct(c["id1"].alias("id1"), c["id2"].alias("id2"), c["n"].alias("n")))
    rows = rows.select(
        "conv_id", "seg", ids.alias("ids"), F.when(F.col("n_turns") > (F.col("seg") + 1) * width, 1).otherwise(0).cast("long").alias("going"),
        F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + c["n"]).alias("tokens"), "n_turns")
    rows = rows.withColumn("g1", F.xxhash64("seg", "ids")).withColumn("g2", F.xxhash64(F.lit(1), "ids", "seg")).withColumn("chunk", F.floor(F.col("seg") / CHUNK))
    # The key of a beginning is the XOR of the hashes of its numbered segments: a running value, carried over chunks.
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.filter(F.col("n_turns") > CHUNK * width).groupBy("conv_id", "chunk").agg(F.bit_xor("g1").alias("g1"), F.bit_xor("g2").alias("g2"), F.sum("tokens").alias("tokens"))
    carries = sums.select("conv_id", "chunk", F.bit_xor("g1").over(before).alias("c1"), F.bit_xor("g2").over(before).alias("c2"), F.sum("tokens").over(before).alias("ct"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    running = rows.withColumns({"x1": zero(F.bit_xor("g1").over(inside)), "x2": zero(F.bit_xor("g2").over(inside)), "xt": zero(F.sum("tokens").over(inside))})
    running = running.join(carries, ["conv_id", "chunk"], "left").withColumns({
        "root1": F.col("x1").bitwiseXOR(zero(F.col("c1"))), "root2": F.col("x2").bitwiseXOR(zero(F.col("c2"))), "before": F.col("xt") + zero(F.col("ct"))})
    return running.select("conv_id", "seg", "ids", "going", "tokens", "root1", "root2", "before",
                          F.col("root1").bitwiseXOR(F.col("g1")).alias("tail1"), F.col("root2").bitwiseXOR(F.col("g2")).alias("tail2"))


# Nodes of a shard.


def shard_nodes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Records of the nodes that the rows of one shard take part in."""
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    column = {name: rows.column(name).to_numpy() for name in rows.column_names if name != "ids"}
    ids = rows.column("ids").chunk(0)
    sizes = np.asarray(ids.value_lengths())
    cells = ids.flatten()
    count, depth = len(sizes), int(sizes.max())
    row = np.repeat(np.arange(count), sizes)
    col = np.arange(len(cells)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    matrix = np.full((2, depth, count), _PAD)
    tokens = np.zeros((depth, count), dtype=np.int64)
    for k in range(2):
        matrix[k, col, row] = cells.field(k).to_numpy()
    tokens[col, row] = cells.field(2).to_numpy()

    keys = [column["root1"], column["root2"], *(matrix[k, j] for j in range(depth) for k in range(2))]
    order = np.lexsort(keys[::-1])
    matrix, tokens, sizes = matrix[:, :, order], tokens[:, order], sizes[order]
    column = {name: values[order] for name, values in column.items()}
    change = np.ones((depth + 1, count), dtype=bool)
    change[0, 1:] = (column["root1"][1:] != column["root1"][:-1]) | (column["root2"][1:] != column["root2"][:-1])
    if depth:
        change[1:, 1:] = (matrix[:, :, 1:] != matrix[:, :, :-1]).any(axis=0)
    change = np.logical_or.accumulate(change, axis=0)
    tokens_before = column["before"] + np.concatenate([np.zeros((1, count), np.int64), np.cumsum(tokens, axis=0)])
    by_id = np.argsort(column["conv_id"], kind="stable")
    rank = np.empty(count, dtype=np.int64)
    rank[by_id] = np.arange(count)

    rolling = np.zeros((2, count), dtype=np.uint64)
    upper: dict[str, np.ndarray] = {}
    for j in range(depth + 1):
        if j:
            with np.errstate(over="ignore"):
                rolling = mix(rolling * np.uint64(0x9E3779B97F4A7C15) + matrix[:, j - 1].view(np.uint64) + np.uint64(j))
        starts = np.flatnonzero(change[j])
        real = sizes[starts] >= j
        total = lambda values: np.add.reduceat(values, starts)  # noqa: B023, E731
        least = by_id[np.minimum.reduceat(rank, starts)]
        node = {"k1": column["root1"][starts], "k2": column["root2"][starts], "j": np.full(len(starts), j), "r1": rolling[0, starts].view(np.int64), "r2": rolling[1, starts].view(np.int64)}
        node |= {"depth": column["seg"][starts] * width + j, "conv_id": column["conv_id"][least], "q": column["q"][least]}
        node |= {name: total(column[name]) for name in ("n", "sum_q", "sum_leaf", "going")}
        node["before"] = tokens_before[max(j - 1, 0), starts]
        # A child that lies on a border of the shard may go on in another one; those are listed, the others counted.
        node["children"] = total((change[j + 1] & (sizes > j)).astype(np.int64)) if j < depth else np.zeros(len(starts), np.int64)
        edge = np.zeros(len(starts), dtype=bool)
        edge[[0, -1]] = True
        listed: dict[int, list[int]] = {0: [], len(starts) - 1: []}
        if j < depth:
            below = np.flatnonzero(change[j + 1])
            with np.errstate(over="ignore"):
                child = mix(rolling[0] * np.uint64(0x9E3779B97F4A7C15) + matrix[0, j].view(np.uint64) + np.uint64(j + 1)).view(np.int64)
            for at in {int(below[0]), int(below[-1])}:
                if sizes[at] > j:
                    group = int(np.searchsorted(starts, at, side="right")) - 1
                    node["children"][group] -= 1
                    listed[group].append(int(child[at]))
        # Past the last column a node goes on as the root of the next segment.
        on = (j == width) & (node["going"] > 0)
        open_ = edge | on | ((j == 0) & (column["seg"][starts] > 0))
        continued = (j == 0) & (column["seg"][starts] > 0)
        ended = (sizes[starts] == j) & (column["n"][starts] > column["going"][starts])
        for name, other in (("k1", "tail1"), ("k2", "tail2")):
            node[name] = np.where(on, column[other][starts], node[name])
        for name in ("j", "r1", "r2"):
            node[name] = np.where(on, 0, node[name])
        if j:
            parent = np.searchsorted(upper["starts"], starts, side="right") - 1
            far = upper["open"][parent]
            above = {p: (upper[k][parent], ~far) for p, k in zip(_PARENT, _KEY, strict=True)} | {"parent_conv_id": (upper["conv_id"][parent], far)}
        else:
            nothing = (np.zeros(len(starts), np.int64), np.ones(len(starts), bool))
            above = dict.fromkeys((*_PARENT, "parent_conv_id"), nothing)
        for name in ("n", "sum_q", "sum_leaf"):
            node[name] = np.where(continued, 0, node[name])
        chosen = np.flatnonzero(real)
        array = lambda values, mask=None, kind=pa.int64(): pa.array(values[chosen], mask=None if mask is None else mask[chosen], type=kind)  # noqa: B023, B008, E731
        arrays = [array(open_, kind=pa.bool_())] + [array(node[k], kind=pa.int32() if k == "j" else pa.int64()) for k in _KEY] + [array(node["depth"])]
        arrays += [array(node[k], continued) for k in ("conv_id", "q")] + [array(node[k]) for k in ("n", "sum_q", "sum_leaf")] + [array(node["before"], continued), array(node["children"])]
        arrays += [pa.array([listed.get(int(i), []) for i in chosen], type=pa.list_(pa.int64()))]
        arrays += [array(*above[k], kind=pa.int32() if k == "pj" else pa.int64()) for k in _PARENT] + [array(*above["parent_conv_id"])]
        arrays += [array(column[k][starts], ~ended) for k in ("tail1", "tail2")]
        if len(chosen):
            yield pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in _RECORD.split(", ")])
        upper = {**node, "starts": starts, "open": open_}


def all_nodes(rows: DataFrame, width: int, shards: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Complete nodes of the segments ``rows`` (with q and leaf of each conversation), and among them the recombined ones by key."""
    # Equal segments after equal beginnings are one row, summed before the shuffle: copies can't crowd a shard.
    distinct = rows.groupBy("tail1", "tail2", "root1", "root2", "seg", "before").agg(
        F.min(F.struct("conv_id", "q")).alias("head"), F.first("ids").alias("ids"), F.count("*").alias("n"),
        F.sum("q").alias("sum_q"), F.sum("leaf").alias("sum_leaf"), F.sum("going").alias("going"))
    distinct = materialise(distinct.select("*", "head.conv_id", "head.q").drop("head"), f"trie-rows-{name}")
    dealt = distinct.repartitionByRange(shards, "root1", "root2", "ids")
    records = materialise(dealt.mapInArrow(lambda batches: shard_nodes(batches, width), _RECORD), f"trie-records-{name}")
    joined = records.filter("open").groupBy(*_KEY).agg(
        F.max("depth").alias("depth"), F.min(F.when(F.col("conv_id").isNotNull(), F.struct("conv_id", "q"))).alias("head"),
        *(F.sum(c).alias(c) for c in ("n", "sum_q", "sum_leaf")), F.max("before").alias("before"),
        (F.sum("children") + F.size(F.array_distinct(F.flatten(F.collect_list("edge_children"))))).alias("children"),
        F.max(F.when(F.col("p1").isNotNull(), F.struct(*_PARENT))).alias("parent"), F.max("parent_conv_id").alias("parent_conv_id"),
        F.max(F.when(F.col("end1").isNotNull(), F.struct("end1", "end2"))).alias("end"))
    joined = materialise(joined.select(*_KEY, "depth", "head.conv_id", "head.q", "n", "sum_q", "sum_leaf", "before", "children", "parent.*", "parent_conv_id", "end.*"), f"trie-joined-{name}")
    columns = ["depth", "conv_id", "q", "n", "sum_q", "sum_leaf", "before", "children", *_PARENT, "parent_conv_id", "end1", "end2"]
    return records.filter("not open").select(columns).unionByName(joined.select(columns)), joined


def prefix_trie(turns: DataFrame, width: int = WIDTH, shard_rows: int = SHARD_ROWS, least_rows: int = LEAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie of all sequences, and where each sequence ends.

    ``turns`` has conv_id, pos (0, 1, ... without gaps), id1, id2, n (tokens of a turn) and n_turns (of the conversation);
    a conversation without turns has one row, of which pos is null. Nodes: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves (childless nodes in the subtree), saved_tokens (sum over the subtree of members but one
    times tokens), end1 and end2 (null where no sequence ends). Ends: end1, end2, conv_id of each conversation.
    Without turns both are empty. Conversations of any length and copies of any number are split among tasks.
    """
    rows = materialise(segments(turns, width), "trie-segments")
    count = rows.count()
    shards = max(1, -(-count // shard_rows), min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-count // least_rows)))
    first, _ = all_nodes(rows.withColumns({"q": F.lit(0).cast("long"), "leaf": F.lit(0).cast("long")}), width, shards, "first")
    # q: tokens of the path that a conversation shares with a smaller one, all if it is a member of smaller ones' nodes only.
    owned = first.groupBy("conv_id").agg(F.min_by("before", "depth").alias("q"), F.max(F.when(F.col("children") == 0, 1).otherwise(0)).cast("long").alias("leaf"))
    whole = rows.groupBy("conv_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("segs"))
    shares = whole.join(owned, "conv_id", "left").select("conv_id", "segs", F.coalesce("q", "tokens").alias("q"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"))
    shares = materialise(shares, "trie-shares")
    nodes, joined = all_nodes(join_hot(rows, shares, ["conv_id"], "segs"), width, shards, "second")
    keys = joined.select(*(F.col(k).alias(p) for k, p in zip(_KEY, _PARENT, strict=True)), F.col("conv_id").alias("far_parent"), F.col("children"))
    far = join_hot(nodes.filter("p1 is not null").withColumnRenamed("children", "n_children"), keys, list(_PARENT), "children")
    near = nodes.filter("p1 is null").withColumnRenamed("children", "n_children").withColumn("far_parent", F.lit(None).cast("long"))
    nodes = far.unionByName(near).select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "far_parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", F.col("sum_leaf").alias("n_leaves"),
        (F.col("sum_q") - F.col("q") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"), "end1", "end2")
    return materialise(nodes, "trie-nodes"), rows.filter("going = 0").select(F.col("tail1").alias("end1"), F.col("tail2").alias("end2"), "conv_id")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each group's ids, which come sorted and packed; one group's text is never whole in memory."""
    key, state, done = None, None, []
    for batch in batches:
        for end1, end2, ids in zip(*(batch.column(c).to_pylist() for c in ("end1", "end2", "ids")), strict=True):
            text = ",".join(map(str, sorted(ids))).encode()
            if (end1, end2) == key:
                state.update(b"," + text)
                continue
            if key is not None:
                done.append((*key, state.hexdigest()))
            key, state = (end1, end2), hashlib.sha256(text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["end1", "end2", "ends_sha256"])
            done = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=["end1", "end2", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """end1, end2, ends_sha256: hash of the ascending conv_ids of each end, joined by commas. Ids are packed before they are shuffled by end."""
    packed = ends.groupBy("end1", "end2", F.floor(F.col("conv_id") / PACK).alias("pack")).agg(F.collect_list("conv_id").alias("ids"))
    return packed.repartition("end1", "end2").sortWithinPartitions("end1", "end2", "pack").mapInArrow(_digests, "end1 long, end2 long, ends_sha256 string")


def with_digests(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes with ends_sha256 in place of their end; the hash of nothing where no sequence ends."""
    ended = nodes.filter("end1 is not null").join(ends_digest(ends), ["end1", "end2"])
    others = nodes.filter("end1 is null").withColumn("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return ended.unionByName(others).drop("end1", "end2")


#: The query's result in SQL, over ``conversations`` (turns with equal numbers apart).
ORACLE = """
    WITH RECURSIVE t AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY pos) AS own FROM t GROUP BY conv_id),
    h AS (SELECT conv_id, own, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
              lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                  lambda x, y: xor(x // 2, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))), CAST(4294967295 AS BIGINT)) % 6 AS h FROM c),
    b AS (SELECT h.conv_id, list_concat(coalesce(list_slice(c.own, 1, h.h), []), coalesce(list_slice(h.own, h.h + 1, len(h.own)), [])) AS seq
          FROM h LEFT JOIN c ON c.conv_id = h.conv_id - h.conv_id % 100),
    m AS (SELECT conv_id, seq, d, CAST(list_slice(seq, 1, d) AS VARCHAR) AS node, CAST(list_slice(seq, 1, d - 1) AS VARCHAR) AS up
          FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM b)),
    n AS (SELECT d, md5(node) AS node, CASE WHEN d > 0 THEN md5(any_value(up)) END AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
                 CASE WHEN d > 0 THEN length(any_value(seq)[d].x) ELSE 0 END AS len,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(seq) = d), '')) AS ends_sha256
          FROM m GROUP BY d, node),
    k AS (SELECT n.*, p.conv_id AS parent_conv_id, coalesce(q.kids, 0) AS n_children FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.node = n.up
          LEFT JOIN (SELECT d - 1 AS d, up, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL) q ON q.d = n.d AND q.up = n.node),
    a AS (SELECT d, node, up, conv_id, d AS top_d, node AS top, (n_children = 0) AS leaf, (n_convs - 1) * len AS saved FROM k
          UNION ALL SELECT a.d, a.node, a.up, a.conv_id, k.d, k.node, a.leaf, a.saved FROM a JOIN k ON k.d = a.top_d - 1
              AND k.node = (SELECT up FROM k z WHERE z.d = a.top_d AND z.node = a.top)),
    s AS (SELECT top_d, top, sum(CAST(leaf AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens FROM a GROUP BY ALL)
    SELECT k.conv_id, CAST(k.d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM k JOIN s ON s.top_d = k.d AND s.top = k.node"""
