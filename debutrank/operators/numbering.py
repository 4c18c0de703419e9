"""Dense numbers in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from debutrank.session import written

# monotonically_increasing_id() keeps the partition in the upper bits and the
# position inside the partition in the lower 33.
_POSITION_BITS = 33


def dense_number(df: DataFrame, keys: str | list[str], name: str = "number") -> DataFrame:
    """Number the rows 0, 1, 2, .. in key order without sorting them in one task.

    Rows are range partitioned and sorted inside the partitions; the partition counts,
    of which there are as many as shuffle partitions, give each partition its offset.
    The ranged rows are written once, since sampled ranges may differ between two runs.
    Give enough keys to make the order total: that also splits a hot key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = written(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_part", F.shiftright("_id", _POSITION_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position)
        .drop("_id", "_part", "_offset")
    )


def continue_numbers(numbered: DataFrame, keys: DataFrame, key: str, name: str = "number") -> DataFrame:
    """Numbers of new keys: those that ``numbered`` (key, number) has not got, from its largest number on.

    In key order and without gaps; null keys are left out, repeats are one key. The old numbers are read for their
    maximum and for the keys only.
    """
    top = numbered.agg(F.max(name)).first()[0]
    fresh = keys.select(key).filter(F.col(key).isNotNull()).distinct().join(numbered.select(key), key, "left_anti")
    return dense_number(fresh, key, name).withColumn(name, F.col(name) + F.lit(0 if top is None else top + 1))
