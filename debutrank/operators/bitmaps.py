"""Exact distinct counts of numbers, as bitmaps that can be merged.

A number is a bit of a 64-bit word; a table of words has one row for each word that is not empty.
Words of the same place are merged with a bitwise or: on the map side, after the shuffle, and with
the words of a later batch. A group of any size is spread over its words.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PLACE = ("what", "owner", "block")


class Counted(NamedTuple):
    """A column of whole numbers; with ``within`` a number counts once for each value of that other one."""

    number: str
    within: str | None = None


def words(rows: DataFrame, keys: Sequence[str], counted: Mapping[str, Counted]) -> DataFrame:
    """``keys, what, owner, block, word``: the numbers of every key, 64 of them to a word.

    ``what`` is the position in ``counted``. Null numbers, and numbers within a null, are not counted.
    """
    marks = []
    for i, c in enumerate(counted.values()):
        number = F.col(c.number).cast("long")
        owner = F.col(c.within).cast("long") if c.within else F.lit(0).cast("long")
        mark = F.struct(
            F.lit(i).alias("what"),
            owner.alias("owner"),
            F.shiftright(number, 6).alias("block"),
            F.expr(f"shiftleft(1L, cast(cast(`{c.number}` as long) & 63 as int))").alias("word"),
        )
        marks.append(F.when(number.isNotNull() & owner.isNotNull(), mark))
    spread = rows.select(*keys, F.explode(F.array(*marks)).alias("m")).filter("m IS NOT NULL")
    return merge_words(spread.select(*keys, "m.*"), keys)


def merge_words(tables: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each word of a union of tables of words."""
    return tables.groupBy(*keys, *_PLACE).agg(F.bit_or("word").alias("word"))


def distinct_counts(table: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``keys`` and a column for each of ``names``: the bits in the words of that position."""
    bits = F.bit_count("word").cast("long")
    return table.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("what") == i, bits)), F.lit(0)).alias(n) for i, n in enumerate(names)]
    )
