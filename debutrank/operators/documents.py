"""Nested documents: one per entity, with its periods and their games."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutrank.functions.periods import season_label, season_start
from debutrank.operators.profile import DIGITS


def game_means(
    games: DataFrame, keys: Sequence[str], game_key: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Per key: sum of each value over all game rows, over the number of distinct games.

    Rounded like the means of the profile that they are compared with, so that the order
    of the additions does not decide a comparison.
    """
    distinct = F.count_distinct(*game_key)
    return games.groupBy(*keys).agg(
        *[
            F.round(F.sum(F.coalesce(F.col(v), F.lit(0.0))) / distinct, DIGITS).alias(v)
            for v in values
        ]
    )


def nest(
    games: DataFrame,
    season_stats: DataFrame,
    entity: str,
    period: str,
    game: str,
    game_fields: Sequence[str],
    stats: Sequence[str],
    parts: int = 1,
) -> DataFrame:
    """Documents ``(entity, seasons)`` from games with unique keys and season rows.

    ``seasons`` maps a period to ``{games: {game: fields}, all: stats}``. The layout is the same for
    every entity and chosen by the caller: with ``parts`` above 1, for tables in which one
    entity has more games than a task can hold, an entity has up to that many documents
    ``(entity, part, seasons)``: a game is in the part that the hash of its key gives, and all
    statistics are in part 0, which every entity with statistics has.
    """
    part = F.pmod(F.xxhash64(period, game), F.lit(parts)).cast("int")
    game_rows = games.select(
        entity, part.alias("part"), period, F.struct(F.col(game), F.struct(*game_fields)).alias("_game")
    )
    stat_rows = season_stats.select(
        entity, F.lit(0).alias("part"), period, F.struct(*stats).alias("all")
    )
    # Both kinds of rows in one aggregation: joining them on the entity would bring
    # all parts of a large one together again. Missing games make an empty map. Lists get no
    # shorter by partial results, so the rows are dealt out once, by document, for both aggregations.
    document = [entity, "part"] if parts > 1 else [entity]
    seasons = (
        game_rows.unionByName(stat_rows, allowMissingColumns=True)
        .repartition(*document)
        .groupBy(entity, "part", period)
        .agg(
            F.map_from_entries(F.sort_array(F.collect_list("_game"))).alias("games"),
            F.any_value("all", ignoreNulls=True).alias("all"),
        )
    )
    season = F.struct(F.col(period), F.struct("games", "all"))
    # Lists come in the order of the shuffle: sorted, two runs store equal documents.
    nested = seasons.groupBy(entity, "part").agg(
        F.map_from_entries(_by_field(F.collect_list(season), period)).alias("seasons")
    )
    return nested if parts > 1 else nested.drop("part")


def _by_field(entries: Column, field: str) -> Column:
    """Structs in the order of one of their fields; the others may be of any type."""

    def compare(a: Column, b: Column) -> Column:
        return F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0)

    return F.array_sort(entries, compare)


def as_entries(documents: DataFrame) -> DataFrame:
    """The season map as sorted entries ``{period, games: [{game, fields..}], all}``.

    A stored array of structs can be read by field, which a map cannot: a scan for one statistic
    reads the columns of the periods and of that statistic.
    """

    def season(e: Column) -> Column:
        games = F.transform(
            F.map_entries(e["value"]["games"]), lambda g: F.struct(g["key"].alias("game"), g["value"].alias("fields"))
        )
        return F.struct(e["key"].alias("period"), F.sort_array(games).alias("games"), e["value"]["all"].alias("all"))

    entries = F.transform(F.map_entries("seasons"), season)
    return documents.withColumn("seasons", F.sort_array(entries))


def as_maps(entries: DataFrame) -> DataFrame:
    """The documents that ``as_entries`` has been given."""

    def season(e: Column) -> Column:
        games = F.transform(e["games"], lambda g: F.struct(g["game"], g["fields"]))
        return F.struct(e["period"], F.struct(F.map_from_entries(games).alias("games"), e["all"].alias("all")))

    return entries.withColumn("seasons", F.map_from_entries(F.transform("seasons", season)))


def entry_stat(period: Column, stat: str) -> Column:
    """Statistic of one period of stored entries; NULL where the period is missing."""
    at = F.array_position(F.col("seasons.period"), period) - 1
    return F.get(F.col(f"seasons.all.{stat}"), at.cast("int"))


def entry_rows(
    entries: DataFrame, keys: Sequence[str], stats: Sequence[str], period: str = "period"
) -> DataFrame:
    """Some statistics of every period, as flat columns; only these are read. A period without statistics has NULLs."""
    columns = [F.col(f"seasons.all.{s}").alias(s) for s in stats]
    zipped = F.arrays_zip(F.col("seasons.period").alias(period), *columns)
    rows = entries.select(*keys, F.explode(zipped).alias("_s"))
    return rows.select(*keys, f"_s.{period}", *[f"_s.{s}" for s in stats])


def explode_seasons(documents: DataFrame, keys: Sequence[str], period: str = "period") -> DataFrame:
    """One row per document and period: the keys, ``games`` and ``all``."""
    return documents.select(*keys, F.explode("seasons").alias(period, "_s")).select(
        *keys, period, "_s.games", "_s.all"
    )


def season_rows(documents: DataFrame, keys: Sequence[str], period: str = "period") -> DataFrame:
    """The statistics of every period, as flat columns."""
    seasons = documents.select(*keys, F.explode("seasons").alias(period, "_s"))
    return seasons.filter(F.col("_s.all").isNotNull()).select(*keys, period, "_s.all.*")


def season_stat(period: Column, stat: str) -> Column:
    """Statistic of one period of a document; NULL where the period is missing."""
    return F.try_element_at(F.col("seasons"), period)["all"][stat]


def compact(documents: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """The season map as an array of ``{season, stats: [{stat: value}, ..]}``."""

    def entry(e: Column) -> Column:
        values = [F.create_map(F.lit(s), e["value"]["all"][s]) for s in stats]
        return F.struct(e["key"].alias("season"), F.array(*values).alias("stats"))

    with_stats = F.filter(F.map_entries("seasons"), lambda e: e["value"]["all"].isNotNull())
    return documents.select(*keys, F.transform(with_stats, entry).alias("seasons"))


def with_labels(documents: DataFrame) -> DataFrame:
    """Season labels instead of years as map keys, as JSON files need text keys."""
    labelled = F.transform_keys("seasons", lambda k, _: season_label(k))
    return documents.withColumn("seasons", labelled)


def with_years(documents: DataFrame) -> DataFrame:
    """Years instead of season labels as map keys."""
    years = F.transform_keys("seasons", lambda k, _: season_start(k))
    return documents.withColumn("seasons", years)
