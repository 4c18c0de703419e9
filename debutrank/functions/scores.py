"""Threshold predicates, weighted sums, bonuses and rescaling."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from debutrank.categories import Bonus, Threshold

COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    ">=": operator.ge,
    ">": operator.gt,
    "<=": operator.le,
    "<": operator.lt,
    "==": operator.eq,
    "!=": operator.ne,
}


def threshold_holds(threshold: Threshold, value: Column, mean: Column) -> Column:
    if threshold.comparison not in COMPARISONS:
        raise ValueError(f"unknown comparison {threshold.comparison!r}")
    compare = COMPARISONS[threshold.comparison]
    return compare(value, mean * F.lit(threshold.factor))


def thresholds_hold(
    thresholds: Iterable[Threshold],
    value: Callable[[str], Column],
    mean: Callable[[str], Column],
) -> Column:
    """Conjunction of all thresholds; an empty list holds."""
    tests = [threshold_holds(t, value(t.stat), mean(t.stat)) for t in thresholds]
    return reduce(operator.and_, tests, F.lit(True))


def weighted_sum(weights: Mapping[str, float], value: Callable[[str], Column]) -> Column:
    """Sum of ``value * weight``, always added in the order of the names."""
    terms = [value(stat) * F.lit(float(weights[stat])) for stat in sorted(weights)]
    return reduce(operator.add, terms)


def bonus_term(bonus: Bonus, value: Column, mean: Column) -> Column:
    """Also applies where the statistic is zero."""
    return F.lit(float(bonus.weight)) * (value - mean) * F.lit(bonus.sign)


def bonus_sum(
    bonuses: Iterable[Bonus],
    value: Callable[[str], Column],
    mean: Callable[[str], Column],
) -> Column:
    return reduce(
        operator.add, [bonus_term(b, value(b.stat), mean(b.stat)) for b in bonuses], F.lit(0.0)
    )


def minmax(value: Column, low: Column, high: Column) -> Column:
    """Position of the value between two bounds; NULL where the bounds are equal."""
    return F.try_divide(value - low, high - low)


def shifted_rescale(value: Column, low: Column, high: Column, top: float = 100.0) -> Column:
    """Rescale to ``0..top``; values are shifted only when the lowest one is negative."""
    shift = F.least(low, F.lit(0.0))
    return F.try_divide((value - shift) * F.lit(float(top)), high - shift)


def plain_rescale(value: Column, high: Column, top: float = 100.0) -> Column:
    """``value * top / high`` without a shift."""
    return F.try_divide(value * F.lit(float(top)), high)
