"""First-wins insertion of pages keyed by title."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Keep the earliest row of every key.

    Spark limits each key to one row per task before the shuffle (WindowGroupLimit), so a key
    that holds a large share of the rows arrives as one row per task.
    """
    window = Window.partitionBy(*key).orderBy(*arrival)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def new_rows(arriving: DataFrame, stored: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Rows an insert-or-ignore would add to ``stored``."""
    return first_wins(arriving.join(stored.select(*key), list(key), "left_anti"), key, arrival)
