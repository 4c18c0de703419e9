"""Contiguous shards of equal bytes, from prefix sums over per-partition totals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debutrank.llm import kernels as K
from debutrank.session import written


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1 for the separator."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(1)


def _positions(size: int) -> callable:
    """Adds the partition, the row's number and the bytes before it in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(sizes)
            arrays = [
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(rows, rows + n, dtype=np.int64)),
                pa.array(ends - sizes),
            ]
            names = [*batch.schema.names, "__part", "__number", "__before"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names)
            rows, total = rows + n, int(ends[-1]) if n else total

    return run


def shard_by_bytes(
    df: DataFrame, keys: list[str], shards: int, size: Column | None = None, partitions: int | None = None
) -> DataFrame:
    """Cut the rows, in the order of ``keys``, into contiguous shards of nearly equal bytes.

    Adds ``size``, ``shard`` (0 .. shards - 1) and ``slot`` (0, 1, .. inside the shard). A row goes
    to the shard in whose stretch of total / shards bytes its middle lies, so a shard differs from
    the target by at most one row at either end.

    Rows are range partitioned once, sorted, numbered in a stream and written to the shared
    folder; the totals per partition (one row for each) give the prefix sums, and nothing is
    sorted in one task. Nulls come first. Rows with equal keys (also a third of all) are spread
    by an added row number; where they also agree in the other columns, it does not matter which
    comes first. An empty table gives an empty result. ``size`` is that of the column ``text``
    unless given, must not be negative, and null counts as 0. Input columns named ``size``,
    ``shard`` or ``slot`` are replaced.
    """
    kept = [c for c in df.columns if c not in ("size", "shard", "slot")]
    sized = df.withColumn("__size", F.coalesce((text_bytes() if size is None else size).cast("long"), F.lit(0)))
    sized = sized.select(*[f"`{c}`" for c in kept], F.col("__size").alias("size"))
    order = [*[f"`{k}`" for k in keys], "__row"]
    ranged = sized.withColumn("__row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*([partitions] if partitions else []), *order)
    ranged = ranged.sortWithinPartitions(*order).drop("__row")
    schema = K.wider(ranged.schema, ("__part", "integer"), ("__number", "long"), ("__before", "long"))
    rows = written(ranged.mapInArrow(_positions(len(kept)), schema), "ranged")

    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("__part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    totals = totals.select(
        "__part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__rows"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__bytes"),
        F.sum("bytes").over(Window.partitionBy()).alias("__total"),
    )
    start = F.col("__bytes") + F.col("__before")
    # twice the middle, so that no half is lost; decimals, so that no product overflows
    middle = (2 * start + F.col("size")).cast("decimal(20,0)") * F.lit(shards).cast("decimal(10,0)")
    shard = F.floor(middle / (2 * F.greatest(F.col("__total"), F.lit(1))).cast("decimal(20,0)"))
    placed = rows.join(F.broadcast(totals), "__part")  # one row for each partition written
    placed = placed.withColumn("shard", F.least(shard, F.lit(shards - 1)).cast("int"))
    placed = placed.withColumn("__number", F.col("__rows") + F.col("__number"))
    firsts = placed.groupBy("shard").agg(F.min("__number").alias("__first"))
    placed = placed.join(F.broadcast(firsts), "shard")  # one row for each shard
    return placed.select(
        *[f"`{c}`" for c in kept], "size", "shard", (F.col("__number") - F.col("__first")).alias("slot")
    )
