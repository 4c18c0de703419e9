"""First-wins and last-wins removal of repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # The limit on row_number is applied before the shuffle as well, so that a hot key
    # sends at most one row per map task.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key; ``order`` has to be a total order within a key."""
    return _one_per_key(df, keys, [F.col(c).asc() for c in order])


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row of each key; ``order`` has to be a total order within a key."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in order])
