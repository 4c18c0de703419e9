"""Plain-Python versions of the scoring, written from the specification, for small data."""

from __future__ import annotations

import operator
import statistics

from debutrank.categories import Category

_OPS = {
    ">=": operator.ge, ">": operator.gt, "<=": operator.le,
    "<": operator.lt, "==": operator.eq, "!=": operator.ne,
}


def profile_of(seasons, stats):
    """{period: {stat: (mean, variance, max, min)}} of ``{(entity, period): {stat: value}}``."""
    out = {}
    for period in {p for _, p in seasons}:
        rows = [v for (_, p), v in seasons.items() if p == period]
        out[period] = {}
        for s in stats:
            values = [r[s] for r in rows]
            variance = statistics.variance(values) if len(values) > 1 else 0.0
            mean = round(sum(values) / len(values), 9)
            out[period][s] = (mean, variance, max(values), min(values))
    return out


def score_of(entity, seasons, profile, c: Category, longest=4):
    periods = {p for e, p in seasons if e == entity}
    total, passed, period = 0.0, 0, min(periods)
    for _ in range(longest):
        if period not in periods:
            break
        row, prof = seasons[entity, period], profile[period]
        if all(_OPS[t.comparison](row[t.stat], prof[t.stat][0] * t.factor) for t in c.thresholds):
            passed += 1
            annual = sum(row[s] * w for s, w in c.weights.items())
            total += annual
            for b in c.bonuses:
                total += annual * b.weight * (row[b.stat] - prof[b.stat][0]) * b.sign
        period += 1
    return 100 * total / max(passed, 1)


def rescale(scores, top=100.0):
    low = min(min(scores.values()), 0.0)
    high = max(scores.values()) - low
    return {k: (v - low) * top / high if high else None for k, v in scores.items()}
