"""Merging of category results, totals, and the roll-up from groups to regions."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutrank.operators.ranking import rescale_columns


def merge_categories(
    base: DataFrame, scores: DataFrame, key: str, shorts: Sequence[str]
) -> DataFrame:
    """Left join the base rows to their scores in all categories.

    ``scores`` is long (key, category, score) with one row per key and category. One
    aggregation and one join, both on the key, replace a join per category.
    """
    wide = scores.groupBy(key).agg(
        *[
            F.max(F.when(F.col("category") == s, F.col("score"))).alias(f"{s}_score")
            for s in shorts
        ]
    )
    return base.join(wide, key, "left")


def total(columns: Sequence[str]) -> Column:
    """Sum of the columns in the given order; a missing score counts as 0."""
    return reduce(operator.add, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])


def with_total(rows: DataFrame, columns: Sequence[str], name: str = "score") -> DataFrame:
    return rows.withColumn(name, total(columns))


def present(rows: DataFrame, columns: Sequence[str], name: str = "score") -> DataFrame:
    """Every column rescaled by its own maximum, and their total."""
    return with_total(rescale_columns(rows, columns), columns, name)


def roll_up(
    regions: DataFrame, groups: DataFrame, region: str, columns: Sequence[str]
) -> DataFrame:
    """Sum of the groups' columns per region; a region without groups gets 0."""
    sums = groups.groupBy(region).agg(*[F.sum(c).alias(c) for c in columns])
    keys = [c for c in regions.columns if c not in columns]
    return regions.select(*keys).join(sums, region, "left").fillna(0.0, subset=list(columns))
