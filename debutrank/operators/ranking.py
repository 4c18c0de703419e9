"""Rescaling, grouping and ranking of scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from debutrank.functions.cells import MISSING_GROUP
from debutrank.functions.scores import plain_rescale, shifted_rescale
from debutrank.session import written_with_extrema


def extrema(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``<column>_max`` and ``<column>_min``."""
    return rows.agg(
        *[f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.max, F.min)]
    )


def _with_bounds(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the extrema as one struct: a scalar subquery, so one row by construction.

    It is a column of its own rather than part of each expression, so that it is
    planned once however many columns use it.
    """
    one = extrema(rows, columns)
    return rows.withColumn("_bounds", one.select(F.struct(*one.columns)).scalar())


def rescale(
    rows: DataFrame, columns: Sequence[str] | str, top: float = 100.0, bounds: Mapping[str, object] | None = None
) -> DataFrame:
    """Rescale each column to 0..top over all rows, shifting a column with a negative minimum.

    ``bounds`` has ``<column>_max`` and ``<column>_min`` where they are known, for instance from
    ``session.written_with_extrema``; else they are a second read of the rows.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    kinds = dict(rows.dtypes)

    def bound(c, which):
        if bounds is None:
            return F.col(f"_bounds.{c}_{which}")
        return F.lit(bounds[f"{c}_{which}"]).cast(kinds[c])

    def value(c):
        return shifted_rescale(F.col(c), bound(c, "min"), bound(c, "max"), top)

    bounded = _with_bounds(rows, columns) if bounds is None else rows
    return bounded.select(*[value(c).alias(c) if c in columns else c for c in rows.columns])


def rescale_written(rows: DataFrame, columns: Sequence[str] | str, label: str, top: float = 100.0) -> DataFrame:
    """Write the rows, take their extrema in passing, and rescale what was written: one read of it."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    stored, bounds = written_with_extrema(rows, label, columns)
    return rescale(stored, columns, top, bounds)


def rescale_columns(rows: DataFrame, columns: Sequence[str], top: float = 100.0) -> DataFrame:
    """Rescale each column by its own maximum, without a shift."""

    def value(c):
        return plain_rescale(F.col(c), F.col(f"_bounds.{c}_max"), top)

    bounded = _with_bounds(rows, columns)
    return bounded.select(*[value(c).alias(c) if c in columns else c for c in rows.columns])


def with_group(
    scores: DataFrame, members: DataFrame, entity: str = "entity", group: str = "grp"
) -> DataFrame:
    """Group of each scored entity; entities without one belong to the group ``null``."""
    joined = scores.join(members.select(entity, group), entity, "left")
    return joined.withColumn(group, F.coalesce(F.col(group), F.lit(MISSING_GROUP)))


def group_sum_count(
    rows: DataFrame, group: str, columns: Sequence[str] | str, count: str = "members"
) -> DataFrame:
    """Sum of the columns and number of rows per group."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return rows.groupBy(group).agg(
        *[F.sum(c).alias(c) for c in columns], F.count("*").alias(count)
    )


def sum_and_last(
    rows: DataFrame, name: str, score: str, last: str, order: Sequence[str]
) -> DataFrame:
    """Per name: the sum of the scores, and ``last`` of the final row in ``order``."""
    # A plain column keeps the aggregation on the hash path; a struct needs a sort.
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return rows.groupBy(name).agg(
        F.sum(score).alias(score), F.max_by(last, position).alias(last)
    )


def top_k(rows: DataFrame, k: int, score: str, tie: Sequence[str]) -> DataFrame:
    """The k best rows, in order. Each task sends its k best to one, so ``k`` is for a report, not for a share of the rows."""
    return rows.orderBy(F.col(score).desc(), *tie).limit(k)


def top_k_per(
    rows: DataFrame, by: str, k: int, score: str, tie: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """The k best rows of each value of ``by``; map tasks send at most k rows per value."""
    window = Window.partitionBy(by).orderBy(F.col(score).desc(), *tie)
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
