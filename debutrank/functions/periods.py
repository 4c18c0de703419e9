"""Season labels of the form ``1999-2000``."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def season_label(start: Column) -> Column:
    """Label of the season that starts in the given year."""
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def season_start(label: Column) -> Column:
    """First year of a label."""
    return F.split(label, "-")[0].try_cast("int")


def shift_label(label: Column, years: int = 1) -> Column:
    """The label ``years`` seasons later."""
    return season_label(season_start(label) + F.lit(years))
