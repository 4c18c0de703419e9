"""From the three files to the season table, the profile and the documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutrank.functions.cells import (
    MISSING_GROUP,
    MISSING_REGION,
    default_missing,
    lenient_double,
)
from debutrank.functions.periods import season_start
from debutrank.operators.dedupe import dedupe_first, dedupe_last
from debutrank.operators.documents import as_maps, compact, game_means, nest
from debutrank.operators.joins import limit_entities, look_up
from debutrank.operators.numbering import dense_number
from debutrank.operators.profile import STORED_STATS_PER_PASS, profile
from debutrank.schemas import FILE_STATS, GAME_FIELDS, GAME_FILE, GAME_MEANS, STATS
from debutrank.session import bucketed, written
from debutrank.sources.store import number_stored, read_entries, write_entries, write_profile
from debutrank.sources.tsv import (
    FILE_ORDER,
    read_games,
    read_players,
    read_season_stats,
)


@dataclass(frozen=True)
class Tables:
    """``seasons``: entity, period, 26 statistics. ``members``: entity, name, grp, region.

    ``documents``: the nested documents, if they were asked for. ``rejected``: game rows whose
    season cannot be read, which are in none of the other tables. Seasons and members are stored in the same
    buckets of the entity, so that scoring and grouping need no exchange by it. ``malformed``: kind of file, file
    and text of the lines that could not be read at all.
    """

    seasons: DataFrame
    profile: DataFrame
    members: DataFrame
    documents: DataFrame | None = None
    rejected: DataFrame | None = None
    malformed: DataFrame | None = None


def clean_games(games: DataFrame) -> DataFrame:
    """Empty cells become ``0``."""
    return default_missing(games, GAME_FILE.values())


def season_table(games: DataFrame, season_stats: DataFrame) -> DataFrame:
    """Statistics of every player and season that has games, as numbers.

    The file statistics come from the first matching row of the season file; the two
    derived means from the games.
    """
    keys = ["player_id", "season"]
    numbers = games.withColumns({c: lenient_double(c) for c in GAME_MEANS})
    means = game_means(numbers, keys, ["season_game"], GAME_MEANS)
    found = look_up(means, season_stats, keys, FILE_STATS, order=FILE_ORDER)
    return found.select(
        F.col("player_id").alias("entity"),
        season_start(F.col("season")).alias("period"),
        *[lenient_double(c).alias(c) for c in FILE_STATS],
        *GAME_MEANS,
    )


def members_table(players: DataFrame) -> DataFrame:
    first = dedupe_first(players, ["player_id"], FILE_ORDER)
    return first.select(
        F.col("player_id").alias("entity"),
        "name",
        F.col("college").alias("grp"),
        F.col("state").alias("region"),
    )


def populate(
    spark: SparkSession,
    players_path: str,
    season_stats_path: str,
    games_path: str,
    limit: int = -1,
    store: str | None = None,
    numbers: str | None = None,
) -> Tables:
    """Read the files, build the tables once and write them to the shared folder.

    With ``store``, a folder that is still empty, the documents are built as well, and they, their compacted
    form and the profile by period are written there. ``numbers`` names the table of the players' numbers that goes
    from load to load (it is made by the first): a player keeps the number, new ones follow.
    """
    read = {
        "players": read_players(spark, players_path),
        "seasons": read_season_stats(spark, season_stats_path),
        "games": read_games(spark, games_path),
    }
    kinds = [r.rejected.select(F.lit(kind).alias("kind"), "*") for kind, r in read.items()]
    malformed = reduce(DataFrame.unionByName, kinds)
    games, stats, players = read["games"].rows, read["seasons"].rows, read["players"].rows
    readable = season_start(F.col("season")).isNotNull()
    rejected = written(games.filter(~readable), "rejected")
    games = clean_games(games.filter(readable))
    games = limit_entities(games, "player_id", limit)
    seasons = bucketed(season_table(games, stats), "seasons", ["entity"])
    measures = written(profile(seasons, stats_per_pass=STORED_STATS_PER_PASS), "profile")
    members = bucketed(members_table(players), "members", ["entity"])
    nested = None
    if store:
        nested = documents(games, seasons, members, numbers)
        write_entries(nested, f"{store}/documents")
        nested = as_maps(read_entries(spark, f"{store}/documents"))
        compacted = compact(nested, ["player_id", "college", "state"], STATS)
        compacted.write.parquet(f"{store}/compacted")
        write_profile(measures, f"{store}/profile")
    return Tables(seasons, measures, members, nested, rejected, malformed)


def documents(
    games: DataFrame, seasons: DataFrame, members: DataFrame, kept_numbers: str | None = None
) -> DataFrame:
    """One document per player: id, college, state, number and the season map.

    ``games`` comes with the file order: the last row of a repeated game wins.
    """
    unique = dedupe_last(games, ["player_id", "season", "season_game"], FILE_ORDER)
    rows = unique.select(
        F.col("player_id").alias("entity"),
        season_start(F.col("season")).alias("period"),
        "season_game",
        *GAME_FIELDS,
    )
    nested = nest(rows, seasons, "entity", "period", "season_game", GAME_FIELDS, STATS)
    return numbered_documents(nested, members, kept_numbers)


def numbered_documents(
    nested: DataFrame, members: DataFrame, kept_numbers: str | None = None, entities: DataFrame | None = None
) -> DataFrame:
    """Documents with a dense number, and college and state or the labels for missing ones.

    With ``kept_numbers``, the path of a table that goes from load to load, an entity keeps its number.
    A player without a row in ``members`` keeps the document. ``entities``: all entities of the documents, each once,
    from a table that is cheaper to read. Without it the documents are written first: they are read for the numbers
    and for the join.
    """
    if entities is None:
        nested = written(nested, "nested")
        entities = nested.select("entity").distinct()
    if kept_numbers:
        numbers = number_stored(entities, kept_numbers, "entity").join(entities, "entity", "left_semi")
    else:
        numbers = dense_number(entities, "entity")
    people = numbers.join(members.select("entity", "grp", "region"), "entity", "left")
    group = F.coalesce("grp", F.lit(MISSING_GROUP))
    region = F.when(F.col("grp").isNull(), MISSING_GROUP).otherwise(
        F.coalesce("region", F.lit(MISSING_REGION))
    )
    return nested.join(people, "entity").select(
        F.col("entity").alias("player_id"),
        group.alias("college"),
        region.alias("state"),
        "number",
        *[c for c in nested.columns if c != "entity"],
    )
