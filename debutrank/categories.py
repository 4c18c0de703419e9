"""Scoring categories: weights, thresholds relative to the period mean, and bonuses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from debutrank.schemas import STATS


@dataclass(frozen=True)
class Threshold:
    """``stat <comparison> mean(stat) * factor``, the mean being that of the row's period."""

    stat: str
    comparison: str = ">="
    factor: float = 1.0


@dataclass(frozen=True)
class Bonus:
    """Adds ``annual score * weight * (stat - mean(stat)) * sign``."""

    stat: str
    weight: float
    sign: int = 1


@dataclass(frozen=True)
class Category:
    """A user can build one of these for any set of statistics."""

    name: str
    short: str
    weights: Mapping[str, float]
    thresholds: tuple[Threshold, ...] = ()
    bonuses: tuple[Bonus, ...] = field(default=())

    @property
    def compared_stats(self) -> tuple[str, ...]:
        """Statistics whose period mean is needed."""
        return tuple(sorted({x.stat for x in (*self.thresholds, *self.bonuses)}))

    @property
    def stats(self) -> tuple[str, ...]:
        return tuple(sorted({*self.weights, *self.compared_stats}))

    def check(self, known=STATS) -> Category:
        unknown = [s for s in self.stats if s not in known]
        if unknown:
            raise ValueError(f"category {self.name!r} uses unknown statistics {unknown}")
        return self


# The seven preset categories.
_HALF_MINUTES = Threshold("played_minutes", factor=0.5)
_REGULAR = (_HALF_MINUTES, Threshold("games_played"))
_SHOOTER = (
    Threshold("two_field_goals_attempted"),
    _HALF_MINUTES,
    Threshold("games_played"),
    Threshold("three_field_goals_attempted"),
)

CATEGORIES: tuple[Category, ...] = (
    Category(
        "2_point_shooters",
        "two",
        {
            "two_field_goals_percentage": 0.8,
            "free_throws_percentage": 0.15,
            "three_field_goals_percentage": 0.05,
        },
        _SHOOTER,
    ),
    Category(
        "3_point_shooters",
        "thr",
        {"free_throws_percentage": 0.15, "three_field_goals_percentage": 0.85},
        _SHOOTER,
    ),
    Category(
        "attackers",
        "att",
        {"effective_field_goals_percentage": 0.3, "points": 0.7},
        (Threshold("field_goals_attempted"), _HALF_MINUTES),
    ),
    Category(
        "defenders",
        "def",
        {"defensive_rebounds": 0.5, "steals": 0.3, "blocks": 0.2},
        _REGULAR,
        (Bonus("personal_fouls", 0.2, -1),),
    ),
    Category("rebounders", "reb", {"total_rebounds": 0.9, "steals": 0.1}, _REGULAR),
    Category("plus_minus", "plm", {"plus_minus": 1.0}, _REGULAR),
    Category(
        "all_around",
        "aro",
        {
            "effective_field_goals_percentage": 0.25,
            "free_throws_percentage": 0.25,
            "total_rebounds": 0.17,
            "blocks": 0.16,
            "steals": 0.17,
        },
        _REGULAR,
    ),
)


def category(name: str | Category) -> Category:
    """Look a preset up by its full or short name; an unknown name is an error."""
    if isinstance(name, Category):
        return name
    for preset in CATEGORIES:
        if name in (preset.name, preset.short):
            return preset
    known = ", ".join(c.name for c in CATEGORIES)
    raise ValueError(f"unknown category {name!r}; known: {known}")
