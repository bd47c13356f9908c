"""Periodic runs of words, found with string synchronising sets.

A run is a longest stretch of words with a smallest period that it holds four times at least. Periods of 1 to 3 words are
found by comparing the text with itself moved. For longer ones there is a set of positions at each scale t = 4, 8, 16 ...:
a position is chosen when its t words or those t further have the least hash among all that start from the one to the
other, so that equal surroundings of 2t words choose alike. In a run of period t <= q < 2t one of the first t positions is
chosen, and its nearest chosen position with equal surroundings lies exactly q further. Such pairs propose a period and a
stretch; stretches that overlap are merged, grown word by word and kept if long enough.

Stretches of t words with a period of t / 4 at most choose nothing: they lie in runs found at smaller scales (or by
moving), which is where these highly periodic regions and their periods come from. They keep the sets thin, and a run
of a longer period can't consist of them alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import mix

#: A run holds its period this often at least; the proof that every run is found needs four.
TIMES = 4
#: Periods up to here are found by comparing with the moved text; the least scale is the next power of two.
SMALL = 3
#: Bytes of text worked on at once; a longer single text is taken whole.
BLOCK = 1 << 20

_NEVER = np.iinfo(np.uint64).max
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], true, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def small_runs(ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with a period of SMALL at most."""
    found = []
    for q in range(1, min(SMALL, len(ids) - 1) + 1):
        first, last = _stretches((ids[q:] == ids[:-q]) & (doc[q:] == doc[:-q]))
        long = last - first >= (TIMES - 1) * q
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            if q == 1 or (ids[a : a + q] != ids[a]).any():  # else its period is 1
                found.append((a, b - a + q, q))
    return found


def chosen(gram: np.ndarray, skip: np.ndarray, ends: np.ndarray, t: int) -> np.ndarray:
    """Positions of the synchronising set of scale ``t``: ``gram`` hashes t words, ``skip`` marks highly periodic ones."""
    place = np.arange(len(gram))
    own = np.where(skip | (place + t > ends), _NEVER, gram)
    least, span = own.copy(), 1
    while span < t + 1:
        step = min(span, t + 1 - span)
        least[:-step] = np.minimum(least[:-step], least[step:])
        span += step
    far = np.full_like(own, _NEVER)
    far[:-t] = own[t:]
    return np.flatnonzero((place + 2 * t <= ends) & (least != _NEVER) & ((least == own) | (least == far)))


def proposals(at: np.ndarray, around: np.ndarray, t: int) -> list[tuple[int, int]]:
    """(period, position) of chosen positions whose nearest one with equal surroundings is from t to under 2t further."""
    found, live, k = [], np.arange(len(at)), 1
    while len(live):
        live = live[live + k < len(at)]
        live = live[at[live + k] - at[live] < 2 * t]
        same = around[live + k] == around[live]
        hit = live[same]
        gap = at[hit + k] - at[hit]
        found += zip(gap[gap >= t].tolist(), at[hit[gap >= t]].tolist(), strict=True)
        live, k = live[~same], k + 1
    return sorted(found)


def grown(ids: np.ndarray, low: int, high: int, a: int, b: int, q: int) -> tuple[int, int]:
    """The stretch [a, b) of period ``q`` grown as far as the period goes within [low, high)."""
    step = 16
    while a > low:
        m = min(step, a - low)
        wrong = np.flatnonzero(ids[a - m : a] != ids[a - m + q : a + q])
        if len(wrong):
            a -= m - 1 - int(wrong[-1])
            break
        a, step = a - m, 2 * step
    step = 16
    while b < high:
        m = min(step, high - b)
        wrong = np.flatnonzero(ids[b : b + m] != ids[b - q : b + m - q])
        if len(wrong):
            b += int(wrong[0])
            break
        b, step = b + m, 2 * step
    return a, b


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period), in order, of all runs of the texts ids[bounds[k]:bounds[k + 1]] that hold their period four times."""
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    found = set(small_runs(ids, doc))
    with np.errstate(over="ignore"):
        gram = mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        double = lambda g, m: mix(g * np.uint64(0x2545F4914F6CDD1D) + np.concatenate([g[m:], np.zeros(min(m, len(g)), np.uint64)]))
        place, t = np.arange(len(ids)), 1
        while len(sizes) and TIMES * t <= sizes.max():
            if t > SMALL:
                if 2 * len(rest := np.flatnonzero((sizes >= TIMES * t)[doc[place]])) < len(place):  # short texts are done
                    place, gram = place[rest], gram[rest]
                ends = np.searchsorted(place, bounds[1:])[doc[place]]
                periodic = np.zeros(len(place) + 1, dtype=np.int64)
                for start, length, q in found:
                    if 4 * q <= t <= length and (k := int(np.searchsorted(place, start))) < len(place) and place[k] == start:
                        periodic[k] += 1
                        periodic[k + length - t + 1] -= 1
                at = chosen(gram, np.cumsum(periodic[:-1]) > 0, ends, t)
                pairs = proposals(at, double(gram, t)[at], t)
                done = (0, 0, 0)
                for q, k in pairs:
                    a = int(place[k])
                    if q == done[2] and a + q <= done[1] and a >= done[0]:  # within the run grown last, by a period at least
                        continue
                    low, high = int(bounds[doc[a]]), int(bounds[doc[a] + 1])
                    start, end = grown(ids, low, high, a, a + q + 2 * t, q)
                    done = (start, end, q)
                    if end - start >= TIMES * q:
                        found.add((start, end - start, q))
            gram, t = double(gram, t), 2 * t
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run contains after its first period."""
    if runs:
        dropped = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, q in runs:
            dropped[start + q] += 1
            dropped[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)]
    return b" ".join(words)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK bytes of text."""
    size = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
    total, first = np.cumsum(size, dtype=np.int64), 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + BLOCK, side="right")))
        yield batch.slice(first, last - first)
        first = last


def batch_runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _blocks(batch):
            words = [(text or "").encode().split() for text in part.column("text").to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
            every = pa.array([w for one in words for w in one], type=pa.large_binary())
            ids = every.dictionary_encode().indices.to_numpy() if len(every) else np.zeros(0, np.int32)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
            for start, length, q in find_runs(ids, bounds):
                k = int(np.searchsorted(bounds, start, side="right")) - 1
                if length >= least:
                    runs[k].append((start - int(bounds[k]), length, q))
            listed = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            collapsed = [collapse(w, r).decode() for w, r in zip(words, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(w) for w in words], type=pa.int64()), pa.array(listed, type=_RUNS), pa.array(collapsed, type=pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = 6) -> DataFrame:
    """doc_id, n_words, runs and collapsed of each row of ``docs`` (doc_id, text): its runs of ``least`` words or more.

    A run (start, length, period) is a stretch of words, numbered from 0, whose smallest period goes into it four times or
    more and which no neighbouring word extends; runs follow start, then period. collapsed holds the words that no run
    contains after its first period, joined by one space. A null text is an empty one: no words, no runs, collapsed empty.
    Rows stay apart, whether or not their ids or texts repeat; other columns aren't kept.

    Rows are worked on where they are, without a shuffle, in blocks of bounded size; a text is never cut.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: batch_runs(batches, least), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def repeated(text: Column, seed: Column) -> Column:
    """``text`` whose words from number a on repeat p of them: a = seed % n, p = 1 + floor((n - a) / (3 + seed % 8)) of its n words.

    Texts without words, and those with a null seed, stay as they are.
    """
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (seed % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + seed % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when(seed.isNull() | text.isNull() | (n == 0), text).otherwise(F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " "))


def summarise(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run with the greatest length / period (ties: smallest start, then period) and digests of ``periodic_runs``."""
    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda top, run: F.when(
        top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
