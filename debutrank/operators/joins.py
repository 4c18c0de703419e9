"""Look-ups, existence checks and upserts as joins.

Sides that grow with the data carry no broadcast hint: Spark picks the strategy from
their sizes, and splits skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutrank.functions.cells import MISSING_GROUP, MISSING_REGION
from debutrank.operators.dedupe import dedupe_first, dedupe_last
from debutrank.operators.numbering import dense_number


def look_up(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left join to the first match; without ``order`` the keys of ``table`` are unique.

    A key may be repeated in ``table`` any number of times: one row of it per map task
    is shuffled.
    """
    if order:
        table = dedupe_first(table, keys, order)
    out = rows.join(table.select(*keys, *columns), list(keys), "left")
    return out.fillna(dict(defaults)) if defaults else out


def with_region(
    rows: DataFrame, groups: DataFrame, group: str = "college", region: str = "state"
) -> DataFrame:
    """Region of each row's group: missing groups and unknown regions get their labels."""
    # Rows without a group keep their NULL in the join, where NULL keys need no partner; a
    # table row for the label itself would only give what they get anyway.
    absent = F.col(group).isNull() | (F.col(group) == MISSING_GROUP)
    keyed = rows.withColumn("_group", F.when(~absent, F.col(group)))
    found = keyed.join(groups.select(F.col(group).alias("_group"), region), "_group", "left")
    label = F.when(absent, F.lit(MISSING_GROUP)).otherwise(
        F.coalesce(F.col(region), F.lit(MISSING_REGION))
    )
    named = found.withColumn(region, label)
    return named.withColumn(group, F.coalesce(F.col(group), F.lit(MISSING_GROUP))).select(
        group, *[c for c in rows.columns if c != group], region
    )


def insert_if_absent(
    existing: DataFrame, new: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """Existing rows plus the first new row of every key that is not there yet."""
    columns = existing.columns
    fresh = dedupe_first(new, [key], order).join(existing.select(key), key, "left_anti")
    return existing.unionByName(fresh.select(*columns))


def update_if_present(
    rows: DataFrame, updates: DataFrame, key: str, column: str, order: Sequence[str]
) -> DataFrame:
    """Set ``column`` from the last update of the key; updates of unknown keys do nothing."""
    last = dedupe_last(updates, [key], order).select(key, F.col(column).alias("_new"))
    joined = rows.join(last, key, "left")
    old = F.col(column) if column in rows.columns else F.lit(None)
    return joined.withColumn(column, F.coalesce(F.col("_new"), old)).drop("_new")


def upsert(
    existing: DataFrame,
    new: DataFrame,
    updates: DataFrame,
    key: str,
    column: str,
    new_order: Sequence[str],
    update_order: Sequence[str],
) -> DataFrame:
    """Insert the missing base rows, then set one column of the rows that are present."""
    base = insert_if_absent(existing, new, key, new_order)
    return update_if_present(base, updates, key, column, update_order)


def limit_entities(rows: DataFrame, entity: str, limit: int = -1) -> DataFrame:
    """Rows of the first ``limit`` entities in key order; -1 keeps all.

    The entities are numbered in partitions and joined as Spark sees fit.
    """
    if limit < 0:
        return rows
    entities = rows.select(entity).distinct()
    chosen = dense_number(entities, entity, "_number").filter(F.col("_number") < limit)
    chosen = chosen.select(entity)
    return rows.join(chosen, entity, "left_semi")


def replicate(rows: DataFrame, copies: int, key: str) -> DataFrame:
    """Every row ``copies`` times, with the copy number appended to the (text) key."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return (
        rows.withColumn("copy", copy)
        .withColumn(key, F.concat_ws("#", F.col(key).cast("string"), F.col("copy")))
    )
