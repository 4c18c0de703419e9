"""Debut period and the unbroken run of periods that starts there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST_RUN = 4


def debut_period(rows: DataFrame, entity: str, period: str) -> DataFrame:
    return rows.groupBy(entity).agg(F.min(period).alias("debut"))


def first_run(
    rows: DataFrame, entity: str, period: str, longest: int = LONGEST_RUN
) -> DataFrame:
    """Rows of the first ``longest`` periods from the debut, up to the first gap.

    ``rows`` holds one row per entity and (whole-numbered) period. Adds ``debut`` and
    ``run_position``. Both window functions run over rows up to the current one, which
    lets Spark drop later periods before the shuffle.
    """
    ordered = (
        Window.partitionBy(entity)
        .orderBy(period)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = rows.withColumns(
        {"run_position": F.row_number().over(ordered), "debut": F.min(period).over(ordered)}
    )
    return numbered.filter(
        (F.col("run_position") <= longest)
        & (F.col(period) - F.col("debut") == F.col("run_position") - 1)
    )


def season_range(
    rows: DataFrame, debut: str, last: str, name: str = "period", first: int | None = None
) -> DataFrame:
    """One row per period from debut to last, or for the ``first`` periods from the debut.

    A range whose bounds are equal is extended by one period.
    """
    if first is not None:
        end: Column = F.col(debut) + F.lit(first - 1)
    else:
        end = F.when(F.col(last) == F.col(debut), F.col(last) + 1).otherwise(F.col(last))
    # sequence() would count downwards when the bounds are reversed.
    periods = F.when(end >= F.col(debut), F.sequence(F.col(debut), end))
    return rows.withColumn(name, F.explode(periods))


def run_of_map(seasons: Column, longest: int = LONGEST_RUN) -> Column:
    """Periods of the first run, from the keys of a map with whole-numbered keys."""
    debut = F.array_min(F.map_keys(seasons))
    candidates = F.sequence(debut, debut + F.lit(longest - 1))
    no_gap = lambda p: F.forall(
        F.sequence(debut, p), lambda q: F.map_contains_key(seasons, q)
    )
    return F.filter(candidates, no_gap)
