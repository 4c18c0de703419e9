"""SQL of the scoring, generated from the categories."""

from __future__ import annotations

from debutrank.categories import Category
from debutrank.operators.scoring import needed_measures
from debutrank.testbed.registry import number
from debutrank.testbed.seasons import SEASON_CTE, profile_cte


def condition(c: Category) -> str:
    tests = [f"{t.stat} {t.comparison} {t.stat}_mean * {number(t.factor)}" for t in c.thresholds]
    return " AND ".join(tests) or "true"


def weighted(c: Category, scaled: bool = False) -> str:
    def value(s):
        return f"(({s} - {s}_min) / nullif({s}_max - {s}_min, 0))" if scaled else s

    return " + ".join(f"{value(s)} * {number(c.weights[s])}" for s in sorted(c.weights))


def points(c: Category, scaled: bool = False) -> str:
    annual = f"({weighted(c, scaled)})"
    if not c.bonuses:
        return annual
    bonus = " + ".join(
        f"{number(b.weight)} * ({b.stat} - {b.stat}_mean) * {number(b.sign)}" for b in c.bonuses
    )
    return f"{annual} + {annual} * ({bonus})"


def score_ctes(categories, scaled: bool = False) -> str:
    """WITH clauses up to ``scores``: entity and one ``<short>_score`` per category."""
    marks, sums = [], []
    for c in categories:
        k = c.short
        marks.append(f"CASE WHEN {condition(c)} THEN 1 ELSE 0 END AS {k}_passed")
        marks.append(f"CASE WHEN {condition(c)} THEN {points(c, scaled)} ELSE 0e0 END AS {k}_points")
        sums.append(f"100e0 * sum({k}_points) / greatest(sum({k}_passed), 1) AS {k}_score")
    sep = ",\n         "
    return (
        "WITH"
        + SEASON_CTE
        + ","
        + profile_cte(needed_measures(categories, scaled))
        + f""",
marks AS (
  SELECT entity, period,
         {sep.join(marks)}
  FROM seasons JOIN profile USING (period)
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period) AS rn,
         min(period) OVER (PARTITION BY entity) AS debut
  FROM marks
),
scores AS (
  SELECT entity,
         {sep.join(sums)}
  FROM ordered WHERE rn <= 4 AND period - debut = rn - 1 GROUP BY entity
)"""
    )


def rescaled(column: str, source: str) -> str:
    low = f"least((SELECT min({column}) FROM {source}), 0e0)"
    return f"({column} - {low}) * 100e0 / nullif((SELECT max({column}) FROM {source}) - {low}, 0)"


def presented(column: str, source: str) -> str:
    return f"{column} * 100e0 / nullif((SELECT max({column}) FROM {source}), 0)"
