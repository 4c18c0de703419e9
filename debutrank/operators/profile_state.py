"""A profile that is kept up to date: what is stored can be merged with the next batch.

The state of a period has its number of rows and, for each statistic, the mean, the sum of squared
deviations from it, the maximum and the minimum. Two states of a period are merged by the
pairwise formula, which loses no digits to large means, so that a batch costs a read of the batch
and of the stored state, and never of the rows that came before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutrank.operators.profile import DIGITS, OPS
from debutrank.schemas import STATS

ROWS = "n_rows"
_KEPT = {
    "mean": "avg({x})",
    "squares": "var_pop({x}) * count(*)",
    "max": "max({x})",
    "min": "min({x})",
}


def columns(stats: Sequence[str] = STATS) -> list[str]:
    """Columns of a state but for the period."""
    return [ROWS, *[f"{s}_{kept}" for kept in _KEPT for s in stats]]


def state(
    seasons: DataFrame, period: str = "period", stats: Sequence[str] = STATS, stats_per_pass: int | None = None
) -> DataFrame:
    """The state of a batch of season rows: one row per period; missing statistics count as 0.

    As in ``profile``, ``stats_per_pass`` divides the statistics of a stored table among several
    aggregations that are narrow enough for code generation.
    """
    size = stats_per_pass or len(stats)
    parts = [
        seasons.groupBy(period).agg(
            F.count("*").alias(ROWS),
            *[
                F.expr(f"{kept.format(x=f'coalesce(`{s}`, 0D)')} AS `{s}_{name}`")
                for name, kept in _KEPT.items()
                for s in stats[i : i + size]
            ],
        )
        for i in range(0, len(stats), size)
    ]
    renamed = [p.withColumnRenamed(period, f"_p{i}").drop(ROWS) for i, p in enumerate(parts[1:])]
    merged = parts[0]
    for i, part in enumerate(renamed):
        merged = merged.join(part, F.col(period).eqNullSafe(F.col(f"_p{i}"))).drop(f"_p{i}")
    return merged.select(period, *columns(stats))


def merge(left: DataFrame, right: DataFrame, period: str = "period", stats: Sequence[str] = STATS) -> DataFrame:
    """The state of the rows of both states; a period may be in either or in both of them."""
    a, b = left.alias("a"), right.alias("b")
    pairs = a.join(b, F.col(f"a.{period}").eqNullSafe(F.col(f"b.{period}")), "full")
    n_a, n_b = (F.coalesce(F.col(f"{side}.{ROWS}"), F.lit(0)) for side in "ab")
    # A period with a null name is in both sides if both have rows of it.
    name = F.coalesce(F.col(f"a.{period}"), F.col(f"b.{period}"))
    both = (n_a > 0) & (n_b > 0)

    def either(column: str, together: Column) -> Column:
        alone = F.coalesce(F.col(f"a.{column}"), F.col(f"b.{column}"))
        return F.when(both, together).otherwise(alone).alias(column)

    merged = []
    for s in stats:
        mean_a, mean_b = F.col(f"a.{s}_mean"), F.col(f"b.{s}_mean")
        apart = mean_b - mean_a
        merged += [
            either(f"{s}_mean", mean_a + apart * n_b / (n_a + n_b)),
            either(
                f"{s}_squares",
                F.col(f"a.{s}_squares") + F.col(f"b.{s}_squares") + apart * apart * n_a * n_b / (n_a + n_b),
            ),
            either(f"{s}_max", F.greatest(f"a.{s}_max", f"b.{s}_max")),
            either(f"{s}_min", F.least(f"a.{s}_min", f"b.{s}_min")),
        ]
    out = pairs.select(name.alias(period), (n_a + n_b).alias(ROWS), *merged)
    return out.select(period, *columns(stats))


def merge_all(states: Sequence[DataFrame], period: str = "period", stats: Sequence[str] = STATS) -> DataFrame:
    return reduce(lambda a, b: merge(a, b, period, stats), states)


def profile_of(
    kept: DataFrame,
    period: str = "period",
    stats: Sequence[str] = STATS,
    ops: Sequence[str] = OPS,
    digits: int = DIGITS,
) -> DataFrame:
    """The profile, as ``profile`` gives it for all the rows at once; one row has variance 0."""
    measures = {
        "mean": lambda s: F.round(f"{s}_mean", digits),
        "variance": lambda s: F.round(
            F.when(F.col(ROWS) > 1, F.col(f"{s}_squares") / (F.col(ROWS) - 1)).otherwise(0.0), digits
        ),
        "max": lambda s: F.col(f"{s}_max"),
        "min": lambda s: F.col(f"{s}_min"),
    }
    return kept.select(period, *[measures[op](s).alias(f"{s}_{op}") for op in ops for s in stats])
