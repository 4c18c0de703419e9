"""From page tables to the three files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutrank.functions.periods import season_label
from debutrank.operators.joins import with_region
from debutrank.operators.runs import season_range
from debutrank.schemas import FILE_STATS, GAME_FILE
from debutrank.sources.pages import game_rows, listing_players, season_cells, season_rows

_GAME_CELLS = tuple(c for c in GAME_FILE.values() if c not in ("player_id", "season"))


def players(listing_pages: DataFrame, colleges: DataFrame) -> DataFrame:
    """Player file from listing pages (``html``) and a table ``college, state``."""
    found = listing_players(listing_pages.select("html")).drop("position")
    return with_region(found, colleges).select(
        "player_id", "name", "college", "state", "debut", "last"
    )


def season_stats(
    players: DataFrame, player_pages: DataFrame, first: int | None = None
) -> DataFrame:
    """Season file: one row per player and season from debut to last.

    Player pages are ``player_id, html``. Years are those in which a season ends, so
    the season of 2000 is ``1999-2000``. ``first`` limits the seasons to that many.
    """
    years = players.select(
        "player_id",
        F.col("debut").cast("int").alias("debut"),
        F.col("last").cast("int").alias("last"),
    )
    seasons = season_range(years, "debut", "last", "season_end", first)
    rows = season_rows(player_pages.select("player_id", "html"), "html", "season_end")
    with_page = seasons.select("player_id", "season_end").join(
        player_pages.select("player_id").distinct(), "player_id", "left_semi"
    )
    cells = season_cells(with_page.join(rows, ["player_id", "season_end"], "left"), "rows")
    label = season_label(F.col("season_end") - 1)
    return cells.select("player_id", label.alias("season"), *FILE_STATS)


def games(season_stats: DataFrame, game_pages: DataFrame) -> DataFrame:
    """Game file from game-log pages (``player_id, season, html``).

    Only seasons whose row has a number of games are looked at.
    """
    played = season_stats.filter(F.col("games_played") != "").select("player_id", "season")
    pages = game_pages.join(played.distinct(), ["player_id", "season"], "left_semi")
    rows = game_rows(pages.select("player_id", "season", "html"), width=len(_GAME_CELLS))
    return rows.select(
        "player_id",
        "season",
        *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(_GAME_CELLS)],
    )
