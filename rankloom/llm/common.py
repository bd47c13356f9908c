"""What several operators share: reading tables, joins that stand hot keys, shingle hashes of whole batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than 1/HOT_SHARE of all rows is hot; there are fewer than HOT_SHARE of them, whatever the size.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right``, which has each key once with its number of left rows in ``count``.

    Keys that hold over 1/HOT_SHARE of the counted rows, fewer than HOT_SHARE by arithmetic, are
    broadcast; the others are shuffled, and none of them can fill a task. ``right`` should be a
    written table, as it is read three times. ``count`` isn't part of the result.
    """
    total = right.agg(F.sum(count).alias("_total"))
    limit = (total.first()["_total"] or 0) // HOT_SHARE
    hot = right.filter(F.col(count) > limit) if limit else right.limit(0)
    cold = right.filter(F.col(count) <= limit) if limit else right
    names = hot.select(*keys, F.lit(True).alias("_hot"))
    marked = left.join(F.broadcast(names), keys, "left")
    return (
        marked.filter("_hot").drop("_hot").join(F.broadcast(hot.drop(count)), keys, how)
        .unionByName(marked.filter("_hot is null").drop("_hot").join(cold.drop(count), keys, how))
    )


def join_salted(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame) -> DataFrame:
    """Inner join of ``left`` to ``right``, which has each key once and may have rows of any size.

    ``counts`` has each key of ``left`` with its number of rows in ``many``; it should be a written table. A key with over
    1/HOT_SHARE of the rows is split by a hash of the left row, and its right row goes to each of its parts. All that is
    broadcast are the names of these keys, fewer than HOT_SHARE by arithmetic.
    """
    limit = (counts.agg(F.sum("many").alias("total")).first()["total"] or 0) // HOT_SHARE
    hot = counts.filter(F.col("many") > limit).select(*keys, F.ceil(F.col("many") / limit).cast("int").alias("_parts")) if limit else None
    if hot is None:
        return left.join(right, keys)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("_part", F.pmod(F.xxhash64(*left.columns), parts).cast("int")).drop("_parts")
    copies = right.join(F.broadcast(hot), keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copies, [*keys, "_part"]).drop("_part")


def cut(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` at most, so that what is made of a batch stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def numbered(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


# Hashing of words and shingles, many texts at once.

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes of text hashed at once; a longer single text is taken whole.
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a public hash function)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, bounds) of blocks of texts; nulls count as empty."""
    filled = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2], dtype=np.uint8) if filled.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(filled):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _BLOCK, side="right")) - 1)
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (characters other than space and \\t..\\r, A-Z as a-z) and the row it stands in."""
    low = np.where((data >= 65) & (data <= 90), data | 32, data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(low)), dtype=np.uint64)])
    words = mix((sums[end] - sums[start]) * _powers(_INVERSE, len(low) + 1)[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return words, np.searchsorted(bounds, start, side="right") - 1


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    A text with fewer words counts as one shingle of all of them, one without words as the empty set.
    """
    with np.errstate(over="ignore"):
        for _, rows, data, bounds in text_blocks(texts):
            words, row = word_hashes(data, bounds)
            first = np.searchsorted(row, np.arange(rows + 1))
            if len(words) >= width:
                whole = words[: len(words) - width + 1].copy()
                for k in range(1, width):
                    whole = whole * np.uint64(0x2545F4914F6CDD1D) + words[k : len(words) - width + 1 + k]
                whole = mix(whole)
            for k in range(rows):
                a, b = int(first[k]), int(first[k + 1])
                if b - a >= width:
                    yield np.unique(whole[a : b - width + 1])
                elif b > a:
                    short = np.uint64(b - a)
                    for word in words[a:b]:
                        short = short * np.uint64(0x2545F4914F6CDD1D) + word
                    yield mix(np.array([short], dtype=np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
