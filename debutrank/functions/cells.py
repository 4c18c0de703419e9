"""Cleaning of text cells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts that stand for a missing cell, group and region.
MISSING_CELL = "0"
MISSING_GROUP = "null"
MISSING_REGION = "no state"

# Java reads "1.5d", "2f" and "0x1p3" as numbers; in the files they are not.
_NOT_A_NUMBER = r"(?i)[0-9.][dfxp]"


def text_or(col: Column | str, default: str = MISSING_CELL) -> Column:
    """The cell, or ``default`` where it is empty or NULL."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def default_missing(
    df: DataFrame, columns: Iterable[str], default: str = MISSING_CELL
) -> DataFrame:
    """Replace empty and NULL cells of the given text columns, in one projection."""
    return df.withColumns({c: text_or(c, default) for c in columns})


def lenient_double(col: Column | str) -> Column:
    """The number in a text cell; anything that is not a number counts as 0."""
    col = F.col(col) if isinstance(col, str) else col
    number = F.when(~col.rlike(_NOT_A_NUMBER), col.try_cast("double"))
    return F.coalesce(number, F.lit(0.0))
