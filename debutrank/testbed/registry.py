"""Collects the queries with their SQL statements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


class Registry:
    def __init__(self):
        self.queries = {}
        self.sql = {}

    def query(self, name: str, sql: str | None = None):
        """Register ``function(spark, sf_dir)`` under ``name``, with its SQL if there is one."""

        def add(function):
            if name in self.queries:
                raise ValueError(f"query {name!r} is registered twice")
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return add


# Results are cut to a fixed number of decimals before they are compared, with a
# margin that keeps values half-way between two steps on the same side.


def snap(column: Column | str, scale: float = 1e4) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.floor(column * F.lit(scale) + F.lit(0.5001)) / F.lit(scale)


def snap_sql(column: str, scale: str = "1e4") -> str:
    return f"floor({column} * {scale} + 0.5001e0) / {scale}"


def number(x: float) -> str:
    """A DOUBLE literal."""
    return f"{float(x)!r}e0"
