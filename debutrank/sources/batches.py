"""Reading a table in ranges of a number, by key prefix, or in batches of a fixed size.

Any table can be read so, with a filter. A table that is stored by ranges or by prefixes has a folder for each of
them, and a read of some of them opens their files only.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutrank.operators.numbering import dense_number

PREFIXES = tuple(string.ascii_lowercase)
OTHER_PREFIX = "other"


def read_range(
    df: DataFrame, number: str, low: int | None = None, high: int | None = None
) -> DataFrame:
    """Rows with ``low <= number < high``, without a bound that is None; pushed to the scan.

    With neither bound these are all rows that have a number.
    """
    value = F.col(number)
    if low is None and high is None:
        return df.filter(value.isNotNull())
    if low is not None:
        df = df.filter(value >= low)
    return df if high is None else df.filter(value < high)


def range_batches(df: DataFrame, number: str, batches: int) -> list[DataFrame]:
    """The whole table in that many reads of equal ranges, and one of the rows without a number.

    The ranges divide what lies between the smallest and the largest number (statistics of
    the file, for a Parquet table); the first and the last are open, so that rows added
    later are not lost. The rows without a number come last.
    """
    low, high = df.agg(F.min(number), F.max(number)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = -(-(high - low + 1) // batches)
    inner = [low + i * width for i in range(1, batches)]
    bounds = [None, *inner, None]
    reads = [read_range(df, number, a, b) for a, b in zip(bounds, bounds[1:])]
    return [*reads, df.filter(F.col(number).isNull())]


def with_range_batch(df: DataFrame, number: str, size: int, name: str = "batch") -> DataFrame:
    """Label each row with its half-open range, in one scan and without a shuffle."""
    return df.withColumn(name, F.floor(F.col(number) / F.lit(size)).cast("bigint"))


def with_equal_batch(df: DataFrame, number: str, batches: int, name: str = "batch") -> DataFrame:
    """Label each row with the read of ``range_batches`` that it is in: all of them in one scan."""
    low, high = df.agg(F.min(number), F.max(number)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = -(-(high - low + 1) // batches)
    batch = F.floor((F.col(number) - F.lit(low)) / F.lit(width))
    inside = F.least(F.greatest(batch, F.lit(0)), F.lit(batches - 1))
    return df.withColumn(name, F.when(F.col(number).isNull(), F.lit(batches)).otherwise(inside).cast("int"))


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, batches)


def with_prefix(df: DataFrame, key: str, name: str = "prefix") -> DataFrame:
    """Label each row with the first letter of its key; anything but a..z is ``other``."""
    first = F.lower(F.substring(key, 1, 1))
    return df.withColumn(
        name, F.when(first.isin(*PREFIXES), first).otherwise(F.lit(OTHER_PREFIX))
    )


def by_prefix(df: DataFrame, key: str, name: str = "prefix") -> DataFrame:
    """Label each row, and deal the rows out by ranges of prefix and key.

    Their number of pieces is left to Spark. A letter with many keys is in many of them, and a piece
    has few letters, so that a table stored by prefix has few files. An aggregation by prefix needs
    no dealing out: use ``with_prefix``.
    """
    return with_prefix(df, key, name).repartitionByRange(F.col(name), F.col(key))


def with_fixed_batch(
    df: DataFrame, keys: str | list[str], size: int, name: str = "batch"
) -> DataFrame:
    """Batches of exactly ``size`` rows in key order, the last one partial."""
    numbered = dense_number(df, keys, "_number")
    return with_range_batch(numbered, "_number", size, name).drop("_number")


_BY = "_by_"


def write_ranges(df: DataFrame, path: str, number: str, size: int) -> None:
    """Store a table in folders of ``size`` consecutive numbers each, sorted by the number inside.

    Rows are range partitioned by the number, then by a hash of the row, so a folder has few files, and
    one with many rows has more of them, also if all have one number. Rows without a number have a folder of their own.
    """
    labelled = with_range_batch(df, number, size, f"{number}{_BY}{size}")
    hashed = F.xxhash64(*[f"`{c}`" for c, kind in df.dtypes if "map<" not in kind])
    dealt = labelled.repartitionByRange(F.col(number), hashed).sortWithinPartitions(number)
    dealt.write.partitionBy(f"{number}{_BY}{size}").parquet(path)


def read_ranges(
    spark: SparkSession, path: str, number: str, low: int | None = None, high: int | None = None
) -> DataFrame:
    """``read_range`` of a table stored by ranges: only the folders that the range meets are listed as input."""
    df = spark.read.parquet(path)
    folder = next(c for c in df.columns if c.startswith(f"{number}{_BY}"))
    size = int(folder.rsplit(_BY, 1)[1])
    rows = df.filter(F.col(folder).isNotNull())
    if low is not None:
        rows = rows.filter(F.col(folder) >= low // size)
    if high is not None:
        rows = rows.filter(F.col(folder) <= (high - 1) // size)
    return read_range(rows, number, low, high).drop(folder)


def write_prefixes(df: DataFrame, path: str, key: str, name: str = "prefix") -> None:
    """Store a table in a folder for each prefix of the key, sorted by the key inside."""
    by_prefix(df, key, name).sortWithinPartitions(name, key).write.partitionBy(name).parquet(path)


def read_prefixes(
    spark: SparkSession, path: str, prefixes: Sequence[str] | None = None, name: str = "prefix"
) -> DataFrame:
    """Rows of a table stored by prefix, of some prefixes or of all, with the prefix as a column."""
    df = spark.read.parquet(path).withColumn(name, F.col(name).cast("string"))
    return df if prefixes is None else df.filter(F.col(name).isin(*prefixes))


def read_keys(spark: SparkSession, path: str, keys: DataFrame, key: str, name: str = "prefix") -> DataFrame:
    """Rows of a table stored by prefix whose key is in ``keys``, with the prefix as a column.

    Keys are joined with their prefixes: where Spark broadcasts them, it opens the folders of the prefixes found only.
    """
    wanted = with_prefix(keys.select(key).distinct(), key, name)
    return spark.read.parquet(path).join(wanted, [name, key], "left_semi")
