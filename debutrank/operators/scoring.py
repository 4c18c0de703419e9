"""Scores of entities over their first run of periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutrank.categories import Category, category
from debutrank.functions.scores import bonus_sum, minmax, thresholds_hold, weighted_sum
from debutrank.operators.runs import LONGEST_RUN, first_run


PROFILE_ROWS = 10_000  # of a profile that is broadcast: its rows are periods


def needed_measures(categories: Sequence[Category], scaled: bool = False) -> list[str]:
    """Columns of the profile that the categories compare or scale with."""
    means = {f"{s}_mean" for c in categories for s in c.compared_stats}
    bounds = {f"{s}_{op}" for c in categories for s in c.weights for op in ("max", "min")}
    return sorted(means | bounds if scaled else means)


def annual_marks(
    seasons: DataFrame,
    profile: DataFrame,
    categories: Sequence[Category],
    entity: str = "entity",
    period: str = "period",
    scaled: bool = False,
) -> DataFrame:
    """Per entity and period: ``<short>_passed`` and ``<short>_points`` of each category.

    A period that misses a threshold has no points. A missing statistic counts as 0, as it
    does in the profile. The profile has one row per period and only the measures that are
    needed; it is broadcast if it has at most ``PROFILE_ROWS`` of them, which is looked up first,
    because the period is a key with few values. Else Spark chooses the join.
    """
    stats = sorted({s for c in categories for s in c.stats})
    measures = needed_measures(categories, scaled)
    rows = seasons.select(entity, period, *[F.coalesce(F.col(s), F.lit(0.0)).alias(s) for s in stats])
    if measures:
        needed = profile.select(period, *measures)
        few = profile.select(period).limit(PROFILE_ROWS + 1).count() <= PROFILE_ROWS
        rows = rows.join(F.broadcast(needed) if few else needed, period)

    def mean(stat):
        return F.col(f"{stat}_mean")

    def value(stat):
        if not scaled:
            return F.col(stat)
        return minmax(F.col(stat), F.col(f"{stat}_min"), F.col(f"{stat}_max"))

    out = []
    for c in categories:
        passed = thresholds_hold(c.thresholds, F.col, mean)
        annual = weighted_sum(c.weights, value)
        points = annual + annual * bonus_sum(c.bonuses, F.col, mean) if c.bonuses else annual
        out.append(passed.cast("int").alias(f"{c.short}_passed"))
        out.append(F.when(passed, points).otherwise(F.lit(0.0)).alias(f"{c.short}_points"))
    return rows.select(entity, period, *out)


def score_entities(
    seasons: DataFrame,
    profile: DataFrame,
    categories: Sequence[Category | str],
    entity: str = "entity",
    period: str = "period",
    scaled: bool = False,
    longest: int = LONGEST_RUN,
) -> DataFrame:
    """Columns ``<short>_score``, one row per entity, all categories in one pass.

    The points of the first run, times 100, over the number of periods that passed.
    Entities without such a period score 0 and stay in. There is a single shuffle, by
    entity, of the narrow marks.
    """
    chosen = [category(c) for c in categories]
    marks = annual_marks(seasons, profile, chosen, entity, period, scaled)
    sums = [
        (
            F.coalesce(F.sum(f"{c.short}_points"), F.lit(0.0))
            * F.lit(100.0)
            / F.greatest(F.sum(f"{c.short}_passed"), F.lit(1))
        ).alias(f"{c.short}_score")
        for c in chosen
    ]
    return first_run(marks, entity, period, longest).groupBy(entity).agg(*sums)


def score_columns(categories: Sequence[Category | str]) -> list[str]:
    return [f"{category(c).short}_score" for c in categories]


def long_scores(
    wide: DataFrame, keys: Sequence[str], categories: Sequence[Category | str]
) -> DataFrame:
    """One row per key and category: ``category`` (short name) and ``score``."""
    entries = F.array(
        *[
            F.struct(
                F.lit(category(c).short).alias("category"),
                F.col(f"{category(c).short}_score").alias("score"),
            )
            for c in categories
        ]
    )
    return wide.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*")
