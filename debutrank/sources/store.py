"""Stored tables: documents by column or as JSON, the profile, whole or kept up to date, and tables changed by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from debutrank.operators import profile_state
from debutrank.operators.documents import as_entries, with_labels, with_years
from debutrank.operators.joins import upsert
from debutrank.operators.numbering import continue_numbers
from debutrank.schemas import STATS
from debutrank.session import written
from debutrank.sources import keyed

PROFILE_BUCKETS = 4  # a period is one row
NUMBER_BUCKETS = 64


def write_documents(documents: DataFrame, path: str) -> None:
    """Documents as JSON lines, the seasons under their labels."""
    with_labels(documents).write.json(path)


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stored documents; ``schema`` is that of the documents with years as keys."""
    labelled = with_labels(spark.createDataFrame([], schema)).schema
    return with_years(spark.read.schema(labelled).json(path))


def write_entries(documents: DataFrame, path: str) -> None:
    """Documents by column: Parquet, the seasons as sorted entries."""
    as_entries(documents).write.parquet(path)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Documents stored by column; take single statistics with ``documents.entry_rows`` and ``entry_stat``."""
    return spark.read.parquet(path)


def write_profile(profile: DataFrame, path: str, period: str = "period") -> None:
    """The profile, a folder for each period."""
    profile.repartition(period).write.partitionBy(period).parquet(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def start_profile(batch: DataFrame, path: str, period: str = "period") -> None:
    """Store the state of a first batch of season rows (see ``profile_state``)."""
    keyed.create(batch, path, [period], PROFILE_BUCKETS)


def add_to_profile(batch: DataFrame, path: str, period: str = "period", stats: Sequence[str] = STATS) -> None:
    """Merge the state of a further batch into the stored one.

    The batch holds season rows that are in no batch before. Neither these nor untouched periods are read;
    of two writers at once both are merged.
    """
    batch = written(batch, "profile-batch")
    keyed.change(
        batch.sparkSession, path, batch.select(period), lambda kept: profile_state.merge(kept, batch, period, stats)
    )


def kept_profile(spark: SparkSession, path: str, period: str = "period", stats: Sequence[str] = STATS) -> DataFrame:
    """The profile of all batches so far."""
    return profile_state.profile_of(keyed.read(spark, path), period, stats)


def save_upsert(
    path: str,
    new: DataFrame,
    updates: DataFrame,
    key: str,
    column: str,
    new_order: Sequence[str],
    update_order: Sequence[str],
) -> None:
    """``joins.upsert`` into a table of ``keyed``, of which only the buckets of the given keys are read and written."""
    touched = new.select(key).unionByName(updates.select(key))

    def make(existing: DataFrame) -> DataFrame:
        return upsert(existing, new, updates, key, column, new_order, update_order)

    keyed.change(new.sparkSession, path, touched, make)


def number_stored(keys: DataFrame, path: str, key: str, name: str = "number") -> DataFrame:
    """Number the keys of a load by a stored table (key, number), which is made if it is not there.

    A key that the table has keeps its number; new ones follow in key order and are stored. Of two loads at
    once the second numbers its new keys after those of the first. Returns the whole table.
    """
    spark = keys.sparkSession
    kinds = dict(keys.dtypes)
    try:
        keyed.create(spark.createDataFrame([], f"`{key}` {kinds[key]}, `{name}` long"), path, [key], NUMBER_BUCKETS)
    except keyed.Taken:
        pass
    known = keyed.read(spark, path).select(key)
    new = written(keys.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left_anti"), "new-keys")

    def make(present: DataFrame) -> DataFrame:
        # The newest version has all numbers; if it is not the one that is changed, the change is refused.
        return present.unionByName(continue_numbers(keyed.read(spark, path), new, key, name).select(*present.columns))

    keyed.change(spark, path, new, make)
    return keyed.read(spark, path)
