"""Profile of the periods: mean, variance, maximum and minimum of every statistic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutrank.schemas import STATS

OPS = ("mean", "variance", "max", "min")
# Means and variances are compared after rounding, so that the order of the additions
# does not decide a comparison with the mean.
DIGITS = 9
# The partial results of four measures take seven columns, and Spark generates code for
# up to 100 (spark.sql.codegen.maxFields).
STORED_STATS_PER_PASS = 13


# One short SQL text per measure: the profile has over a hundred of them.
_MEASURES = {
    "mean": "round(avg({x}), {digits})",
    "variance": "round(coalesce(var_samp({x}), 0D), {digits})",
    "max": "max({x})",
    "min": "min({x})",
}


def _measure(op: str, stat: str, digits: int) -> Column:
    measure = _MEASURES[op].format(x=f"coalesce(`{stat}`, 0D)", digits=digits)
    return F.expr(f"{measure} AS `{stat}_{op}`")


def profile(
    seasons: DataFrame,
    period: str = "period",
    stats: Sequence[str] = STATS,
    ops: Sequence[str] = OPS,
    digits: int = DIGITS,
    stats_per_pass: int | None = None,
) -> DataFrame:
    """One row per period with columns ``<stat>_<op>``; missing values count as 0.

    Partial results are taken on the map side, so a period that holds most of the rows
    is no heavier than the others after the shuffle. A period with a single row has
    variance 0.

    All measures come from one aggregation unless ``stats_per_pass`` is given. That pays
    for a stored table: the passes read different columns of it, and an aggregation of
    up to ``STORED_STATS_PER_PASS`` statistics is narrow enough for code generation.
    """
    unknown = set(ops) - set(OPS)
    if unknown:
        raise ValueError(f"unknown profile measures {sorted(unknown)}")
    size = stats_per_pass or len(stats)
    passes = [
        seasons.groupBy(period).agg(
            *[_measure(op, s, digits) for op in ops for s in stats[i : i + size]]
        )
        for i in range(0, len(stats), size)
    ]
    merged = reduce(lambda left, right: _side_by_side(left, right, period), passes)
    return merged.select(period, *[f"{s}_{op}" for op in ops for s in stats])


def _side_by_side(left: DataFrame, right: DataFrame, period: str) -> DataFrame:
    renamed = right.withColumnRenamed(period, "_period")
    return left.join(renamed, F.col(period).eqNullSafe(F.col("_period"))).drop("_period")


def profile_long(
    wide: DataFrame, period: str = "period", stats: Sequence[str] = STATS
) -> DataFrame:
    """One row per period and statistic, the measures as columns."""
    entries = F.array(
        *[
            F.struct(F.lit(s).alias("stat"), *[F.col(f"{s}_{op}").alias(op) for op in OPS])
            for s in stats
        ]
    )
    return wide.select(period, F.explode(entries).alias("e")).select(period, "e.*")
