"""Removal of repeated passages: overlapping windows of three lines, found over all documents by hash.

DataFrame functions only. Windows, not texts, are shuffled; texts move once, to meet their covered lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import join_hot
from rankloom.session import materialise

WINDOW = 3
_BLANKS = " \t\r"


def windows(docs: DataFrame) -> DataFrame:
    """One row per window: two hashes (128 bits together), the row it stands in, first and last line.

    Lines are compared without blanks at their ends; blank lines don't count, so a window may reach over some.
    """
    bare = F.transform(F.split("text", "\n"), lambda x: F.trim(x, F.lit(_BLANKS)))
    full = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.filter(
        F.transform(bare, lambda x, i: F.when(x != "", F.struct(i.alias("i"), F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b")))),
        lambda x: x.isNotNull()).alias("full")).filter(F.size("full") >= WINDOW)
    line = lambda k, step: F.get("full", k + step)
    each = F.transform(F.sequence(F.lit(0), F.size("full") - WINDOW), lambda k: F.struct(
        F.xxhash64(*(line(k, s)["a"] for s in range(WINDOW))).alias("w1"), F.xxhash64(*(line(k, s)["b"] for s in range(WINDOW))).alias("w2"),
        line(k, 0)["i"].alias("first_line"), line(k, WINDOW - 1)["i"].alias("last_line")))
    return full.select("doc_id", "text_hash", F.explode(each).alias("w")).select("doc_id", "text_hash", "w.*")


def covered_lines(found: DataFrame) -> DataFrame:
    """Lines of each row that later occurrences of a window cover, merged: doc_id, text_hash, lines (sorted)."""
    firsts = materialise(
        found.groupBy("w1", "w2").agg(
            F.min(F.struct("doc_id", "text_hash", "first_line", "last_line")).alias("f"), F.count("*").alias("n")).filter("n > 1"), "windows")
    same_row = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_hash") == F.col("f.text_hash"))
    start = F.when(same_row, F.greatest("first_line", F.col("f.last_line") + 1)).otherwise(F.col("first_line"))
    later = (
        join_hot(found, firsts, ["w1", "w2"], "n")
        .filter(~(same_row & (F.col("first_line") == F.col("f.first_line"))))
        .select("doc_id", "text_hash", start.alias("start"), "last_line").filter("start <= last_line")
    )
    return (
        later.select("doc_id", "text_hash", F.explode(F.sequence("start", "last_line")).alias("line"))
        .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("covered"))
    )


def _without(lines: Column, covered: Column) -> Column:
    """``lines`` but for the positions in ``covered`` (sorted): the stretches between them, put together."""
    stops = F.concat(covered, F.array(F.size(lines)))
    stretch = lambda stop, k: F.slice(lines, F.coalesce(F.get(stops, k - 1), F.lit(-1)) + 2, stop - F.coalesce(F.get(stops, k - 1), F.lit(-1)) - 1)
    return F.flatten(F.transform(stops, stretch))


def remove_repeated_windows(docs: DataFrame) -> DataFrame:
    """Documents without later occurrences of any three lines in a row; adds n_lines and n_removed.

    The first occurrence, by doc_id and then line, stays. Where a later one overlaps the first in the same document,
    only the lines beyond the first go. Blank lines inside a covered window go with it. Rows that are equal in doc_id
    and text count as one document and get equal results; a null doc_id counts as smaller than any. A null text stays
    null (0 lines), texts of fewer than three full lines stay as they are, a text may become empty. Columns n_lines
    and n_removed of the input are replaced, any others kept.
    """
    base = docs.drop("n_lines", "n_removed")
    covered = covered_lines(materialise(windows(base.filter(F.col("text").isNotNull())), "lines"))
    keyed = base.withColumn("_text_hash", F.xxhash64("text"))
    c = covered.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_of"), F.col("covered").alias("_covered"))
    joined = keyed.join(c, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_text_hash") == F.col("_of")), "left")
    split = joined.withColumn("_lines", F.split("text", "\n"))
    text = F.when(F.col("_covered").isNull(), F.col("text")).otherwise(F.array_join(_without(F.col("_lines"), F.col("_covered")), "\n"))
    return split.select(
        *(text.alias("text") if name == "text" else F.col(name) for name in base.columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.when(F.col("_covered").isNull(), 0).otherwise(F.size("_covered")).cast("long").alias("n_removed"))


ORACLE = """
WITH split_lines AS (
  SELECT doc_id, pos - 1 AS pos, string_split(text, chr(10))[pos] AS line
  FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL)
), bare AS (
  SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(13)) AS line FROM split_lines
), windows AS (
  SELECT * FROM (
    SELECT doc_id, pos, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c, lead(pos, 2) OVER w AS last_pos
    FROM bare WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
  WHERE last_pos IS NOT NULL
), marked AS (
  SELECT *, first_value(doc_id) OVER f AS f_doc, first_value(pos) OVER f AS f_pos, first_value(last_pos) OVER f AS f_last
  FROM windows WINDOW f AS (PARTITION BY a, b, c ORDER BY doc_id, pos)
), covered AS (
  SELECT DISTINCT doc_id, unnest(generate_series(CASE WHEN doc_id = f_doc THEN greatest(pos, f_last + 1) ELSE pos END, last_pos)) AS pos
  FROM marked WHERE NOT (doc_id = f_doc AND pos = f_pos)
), counted AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL) AS text,
         count(*) AS n_lines, count(c.pos) AS n_removed
  FROM split_lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.text, '') END AS text,
       coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id
"""
