"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Windows of documents and of benchmark items are joined by hash, each as it is written and as a template. Windows filled
as in the item always count. The others count where enough slots of their alignment are consistent: the slots that one
value of the item fills are filled by one value of the document. A question asked with other numbers or names is found
like a verbatim copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import mix, text_blocks
from rankloom.session import materialise

#: Words of a window. Shorter items are one window of their own length; below LEAST_WORDS they prove nothing.
WIDTH, LEAST_WORDS = 8, 5
#: Share of the slots of an alignment that must be consistent for its windows with other values to count.
CONSISTENT = 0.5
#: Bits of the table of benchmark windows that thins the windows of documents before they are shuffled.
_TABLE_BITS = 23
_SALTS = 16
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0x2545F4914F6CDD1D)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))
_NUMBER, _NAME, _UNIT = np.uint64(1), np.uint64(2), np.uint64(3)

UNITS = (
    "km m cm mm mi mile miles meter meters metre metres foot feet ft inch inches yard yards kg g mg gram grams kilogram kilograms lb lbs pound pounds ounce ounces ton tons "
    "l ml liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degrees degree celsius fahrenheit mph kmh watt watts volt volts joule joules hz byte bytes kb mb gb tb").split()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _word_table() -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[low:high] = True
    return table


def template_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template code, value, row) of each word of a block of texts.

    Words are runs of letters, digits and bytes of other scripts; a point or comma between digits belongs to a number.
    The value is the hash of the word in lower case. The code is the value, or one of three for numbers, for units after
    a number, and for capitalised words that don't begin a sentence.
    """
    with np.errstate(over="ignore"):
        inside = _word_table()[data]
        digit = (data >= 48) & (data <= 57)
        if len(data) > 2:
            inside[1:-1] |= ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        start = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | edge[:-1])) if len(data) else np.zeros(0, int)
        end = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | edge[1:])) + 1 if len(data) else start
        row = np.searchsorted(bounds, start, side="right") - 1
        upper = (data >= 65) & (data <= 90)
        low = np.where(upper, data | 32, data)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(low)), dtype=np.uint64)])
        value = mix((sums[end] - sums[start]) * _powers(_INVERSE, len(low) + 1)[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(4)
        count = lambda mask: np.concatenate([[0], np.cumsum(mask)])
        letters = count(inside & ~digit & (data != 46) & (data != 44))
        number = letters[end] == letters[start]
        uppers = count(upper)
        stops = count((data == 46) | (data == 33) | (data == 63) | (data == 10) | (data == 58))
        after = np.concatenate([[0], end[:-1]]) if len(end) else end
        first = (stops[start] > stops[np.minimum(after, start)]) | np.concatenate([[True], row[1:] != row[:-1]])[: len(row)]
        name = upper[start] & (uppers[end] - uppers[start] == 1) & (end - start > 1) & ~first if len(start) else np.zeros(0, bool)
        unit = np.concatenate([[False], number[:-1] & (row[1:] == row[:-1])])[: len(row)] & np.isin(value, _unit_values()) if len(row) else np.zeros(0, bool)
        return np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, value))), value, row


_units: list[np.ndarray] = []


def _unit_values() -> np.ndarray:
    if not _units:
        _units.append(np.zeros(0, np.uint64))  # while the units themselves are hashed
        block = next(text_blocks(pa.array([" ".join(UNITS)])))
        _units[0] = template_words(block[2], block[3])[1]
    return _units[0]


def windows(codes: np.ndarray, values: np.ndarray, row: np.ndarray, width: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, hash) of the windows of ``width`` words of each text of a block.

    Each is hashed as it is written and, if it has slots, as a template. A template has literal words for half of
    ``width``; a window with fewer grows to the right and to the left until it has them, to ``longest`` words at most.
    Whether the first word is a name or a unit depends on what stands before the window, so such a template is hashed
    with its first word as written, too.
    """
    n = len(codes)
    with np.errstate(over="ignore"):
        bounds = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])) if n else np.zeros(1, int)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        stop = bounds[text + 1] if n else text
        up, down = _powers(_STEP, n), _powers(_STEP_INVERSE, n)
        sums = lambda x: np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up, dtype=np.uint64)])
        form, written = sums(codes), sums(values)
        literals = np.concatenate([[0], np.cumsum(codes > _UNIT)])
        places, least = np.flatnonzero(codes > _UNIT), (width + 1) // 2

        def hashes(of: np.ndarray, a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
            return (of[b] - of[a]) * down[a] + (b - a + salt).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)

        a = np.flatnonzero(np.arange(n) + width <= stop)
        b = a + width
        out = [(a, b, hashes(written, a, b, 1 << 20))]
        few = literals[b] - literals[a] < least
        slotted = ~few & (literals[b] - literals[a] < width)
        spans = [(a[slotted], b[slotted])]
        turned = (codes == _NAME) | (codes == _UNIT)  # as first words
        first = turned[a] & (literals[b] - literals[a] + 1 >= least)
        as_written = [(a[first], b[first])]
        if few.any() and longest > width:
            # Place of the k-th literal word of the block at least + k; none before the first and after the last.
            padded = np.concatenate([np.full(least, -1), places, np.full(least, n)])
            nearest = np.concatenate([[-1], np.maximum.accumulate(np.where(turned, np.arange(n), -1))])  # before each word
            a, b = a[few], b[few]
            first = turned[a] & (literals[b] - literals[a] + 1 < least)
            starting = nearest[np.maximum(padded[literals[b] + 1], 0)]
            grown = [
                (spans, a, np.maximum(padded[literals[a] + 2 * least - 1] + 1, b)),
                (spans, np.minimum(padded[literals[b]], a), b),
                (as_written, a[first], np.maximum(padded[literals[a[first]] + 2 * least - 2] + 1, b[first])),
                (as_written, np.where(starting > padded[literals[b]], np.minimum(starting, a), -1), b)]
            for to, x, y in grown:
                inside = (x >= 0) & (y <= n)
                x, y = x[inside], y[inside]
                inside = y <= stop[x]
                to.append((x[inside], y[inside]))
        for a, b in spans:
            kept = b - a <= longest
            a, b = a[kept], b[kept]
            out.append((a, b, hashes(form, a, b, 0)))
        for a, b in as_written:
            kept = (b - a <= longest) & turned[a]
            a, b = a[kept], b[kept]
            out.append((a, b, hashes(form, a, b, 0) + values[a] - codes[a]))
        starts, ends, found = (np.concatenate(x) for x in zip(*out, strict=True))
        return starts, ends, mix(found)


def _longs(a: np.ndarray) -> list[int]:
    return a.astype(np.uint64).view(np.int64).tolist()


def _window_rows(df: DataFrame, keys: list[str], schema: str, widths: list[int] | None, longest: int | None, table) -> DataFrame:
    """Windows of the texts of ``df`` (keys, text), those that the table has where one is given.

    ``widths``: of a text with that many words; None stands for WIDTH, or the length of a shorter text. ``longest``: words
    of a window that grows; None stands for the length of the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for first, rows, data, bounds in text_blocks(batch.column(batch.num_columns - 1)):
                codes, values, row = template_words(data, bounds)
                at = np.searchsorted(row, np.arange(rows + 1))
                words = np.diff(at)
                for width in widths if widths is not None else range(LEAST_WORDS, WIDTH + 1):
                    if width < LEAST_WORDS:
                        continue
                    starts, ends, hashes = windows(codes, values, row, width, (len(codes) if longest is None else longest) if width == WIDTH else width)
                    if table is not None:
                        slot = (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
                        kept = np.flatnonzero((table.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
                    else:
                        kept = np.flatnonzero(np.minimum(words[row[starts]], WIDTH) == width)
                    for p, e, h in zip(starts[kept].tolist(), ends[kept].tolist(), _longs(hashes[kept]), strict=True):
                        k = int(row[p])
                        for column, x in zip(out, (first + k, e - p, h, p - int(at[k]), int(words[k]), _longs(codes[p:e]), _longs(values[p:e])), strict=True):
                            column.append(x)
            rows_of = pa.array(out[0], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(rows_of) for n in range(len(keys))), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.int32()), pa.array(out[5], longs), pa.array(out[6], longs)],
                [*keys, "width", "hash", "at", "n_words", "codes", "filled"])

    return df.select(*keys, "text").mapInArrow(run, f"{schema}, width int, hash long, at int, n_words int, codes array<long>, filled array<long>")


def _consistent_share(slots: Column) -> Column:
    """Share of slots (i, d, at) that have the commonest value d of the document for their value i of the item."""
    start = F.struct(F.lit(None).cast("long").alias("i"), F.lit(None).cast("long").alias("d"), F.lit(0).alias("run"), F.lit(0).alias("most"), F.lit(0).alias("total"))

    def step(s: Column, x: Column) -> Column:
        same_i = s["i"].eqNullSafe(x["i"])
        run = F.when(same_i & s["d"].eqNullSafe(x["d"]), s["run"] + 1).otherwise(1)
        return F.struct(
            x["i"].alias("i"), x["d"].alias("d"), run.alias("run"), F.when(same_i, F.greatest(s["most"], run)).otherwise(run).alias("most"),
            F.when(same_i, s["total"]).otherwise(s["total"] + s["most"]).alias("total"))

    agreed = F.aggregate(F.array_sort(slots), start, step, lambda s: s["total"] + s["most"])
    return F.when(F.size(slots) == 0, 1.0).otherwise(agreed / F.size(slots))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, salts: int = _SALTS) -> DataFrame:
    """doc_id, text_hash, item_id, covered, kind, n_windows, first_word: documents that hold a benchmark item.

    ``covered`` is the share of the item's words in windows that the document has filled as in the item, or along
    alignments with a share of CONSISTENT of consistent slots, at least ``coverage``; ``kind`` says whether all of them are filled as in the item (verbatim) or not
    (reparameterised). Rows equal in doc_id and text count once; null and empty texts, and items of under LEAST_WORDS
    words, match nothing. Items that share an item_id are told apart by their text, and each is reported.
    """
    spark = docs.sparkSession
    items = benchmark.filter(F.col("text").isNotNull()).select("item_id", F.xxhash64("text").alias("item_hash"), "text").dropDuplicates(["item_id", "item_hash"])
    asked = materialise(_window_rows(items, ["item_id", "item_hash"], "item_id long, item_hash long", None, None, None), "benchmark")
    sizes = asked.groupBy(F.least("n_words", F.lit(WIDTH)).alias("width")).agg(F.max("n_words").alias("longest")).collect()  # WIDTH - LEAST_WORDS + 1 at most
    widths, longest = [r.width for r in sizes], max((r.longest for r in sizes), default=WIDTH)
    slots = np.zeros(1 << _TABLE_BITS, bool)
    found = asked.select(F.shiftrightunsigned("hash", 64 - _TABLE_BITS).alias("s")).groupBy(F.expr("s >> 12").alias("page")).agg(F.collect_set(F.expr("cast(s & 4095 as int)")).alias("low"))
    for r in found.toLocalIterator():  # pages of a table of fixed size
        slots[(r.page << 12) + np.array(r.low)] = True
    table = spark.sparkContext.broadcast(np.packbits(slots))

    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    seen = _window_rows(texts, ["doc_id", "text_hash"], "doc_id long, text_hash long", widths, longest, table).drop("n_words", "codes")
    # A passage may stand in a third of all documents: its windows are dealt over salts, and the items repeated for each.
    seen = seen.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(salts)).cast("int"))
    asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        "item_id", "item_hash", "n_words", "codes", F.col("filled").alias("item_filled"), F.col("at").alias("item_at"), "width", "hash", "salt")
    met = seen.join(asked, ["hash", "width", "salt"])
    slots = F.filter(
        F.transform("codes", lambda c, k: F.when(c.between(1, 3), F.struct(F.get("item_filled", k).alias("i"), F.get("filled", k).alias("d"), (F.col("item_at") + k).alias("at")))),
        lambda p: p.isNotNull())
    met = met.withColumn("slots", slots).withColumn("same", F.forall("slots", lambda p: p["i"] == p["d"]))
    aligned = met.groupBy("doc_id", "text_hash", "item_id", "item_hash", "n_words", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(F.struct("item_at", "width", "same")).alias("at"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    enough = aligned.withColumn("enough", _consistent_share(F.col("slots")) >= CONSISTENT)
    consistent = enough.withColumn("at", F.filter("at", lambda w: w["same"] | F.col("enough"))).filter(F.size("at") > 0).withColumn("same", F.forall("at", lambda w: w["same"]))
    words = F.array_distinct(F.flatten(F.transform("at", lambda w: F.sequence(w["item_at"], w["item_at"] + w["width"] - 1))))
    whole = consistent.groupBy("doc_id", "text_hash", "item_id", "item_hash", "n_words").agg(
        F.array_distinct(F.flatten(F.collect_set(words))).alias("words"), F.bool_and("same").alias("same"),
        F.sum(F.size("at")).alias("n_windows"), F.min(F.col("shift") + F.array_min(F.col("at.item_at"))).alias("first_word"))
    return whole.withColumn("covered", F.size("words") / F.col("n_words")).filter(F.col("covered") >= coverage).select(
        "doc_id", "text_hash", "item_id", "covered", F.when(F.col("same"), "verbatim").otherwise("reparameterised").alias("kind"), "n_windows", "first_word")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    bad = contaminated(docs, benchmark, coverage).select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash")).distinct()
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    return keyed.join(bad, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_text_hash") == F.col("_hash")), "left_anti").drop("_text_hash")
