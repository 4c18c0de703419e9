"""Extraction of lists, keyed cells and table rows from web pages, with built-in regexes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutrank.functions.cells import MISSING_CELL, MISSING_GROUP, text_or

KEY = "<key>"
_TAG = r"<[^<>]*>"
_LEADING_TEXT = r"(?s)^<[^<>]*>([^<]*)"
_CHILD_TEXT = r"(?s)^<[^<>]*>[^<]*<[a-zA-Z][^<>]*>([^<]*)"


def matches(html: Column, pattern: str | Column, group: int = 1) -> Column:
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.regexp_extract_all(html, pattern, F.lit(group))


def list_entries(
    df: DataFrame,
    html: str,
    patterns: Mapping[str, str],
    lead: str,
    position: str = "position",
    missing: str = MISSING_GROUP,
) -> DataFrame:
    """One row per match of the ``lead`` list, the other lists zipped to it by position.

    A list that is shorter, or an entry that is empty, gives ``missing``.
    """
    kept = [c for c in df.columns if c != html]
    lists = df.select(
        *kept, *[matches(F.col(html), p).alias(f"_{name}") for name, p in patterns.items()]
    )
    zipped = F.slice(F.arrays_zip(*[f"_{name}" for name in patterns]), 1, F.size(f"_{lead}"))
    rows = lists.select(*kept, F.posexplode(zipped).alias(position, "_entry"))
    return rows.select(
        *kept, position, *[text_or(f"_entry._{name}", missing).alias(name) for name in patterns]
    )


def second_else_first(html: Column, pattern: str | Column) -> Column:
    """The second match where there is one, else the first, else NULL."""
    found = matches(html, pattern)
    return F.coalesce(F.get(found, F.lit(1)), F.get(found, F.lit(0)))


def keyed_pattern(template: str, key: Column) -> Column:
    """The template with ``<key>`` replaced by the key of the row, which stands for itself."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(key.cast("string"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    return F.replace(F.lit(template), F.lit(KEY), quoted)


def field_values(
    df: DataFrame, html: str, templates: Mapping[str, str], key: str | None = None
) -> DataFrame:
    """One column per template; templates may contain ``<key>``."""
    kept = [c for c in df.columns if c != html]

    def pattern(template):
        return keyed_pattern(template, F.col(key)) if key and KEY in template else template

    return df.select(
        *kept,
        *[
            second_else_first(F.col(html), pattern(template)).alias(name)
            for name, template in templates.items()
        ],
    )


def direct_else_child(cell: Column) -> Column:
    """Text of a cell: its own leading text, else its first child's text, else ``0``."""
    own = F.nullif(F.regexp_extract(cell, _LEADING_TEXT, 1), F.lit(""))
    child = F.nullif(F.regexp_extract(cell, _CHILD_TEXT, 1), F.lit(""))
    return F.coalesce(own, child, F.lit(MISSING_CELL))


def row_cells(
    df: DataFrame,
    html: str,
    row_pattern: str,
    cell_pattern: str,
    width: int,
    name: str = "cells",
    position: str = "position",
    skip: int = 0,
) -> DataFrame:
    """One row per page row that matches, as an array of cell texts.

    ``row_pattern`` has to ask for the expected id, so that other rows are skipped.
    The first ``skip`` cells are left out. A row that is then not ``width`` long gets
    one ``0`` appended.
    """
    kept = [c for c in df.columns if c != html]
    rows = df.select(*kept, F.posexplode(matches(F.col(html), row_pattern)).alias(position, "_row"))
    found = matches(F.col("_row"), cell_pattern, 0)
    kept_cells = F.slice(found, skip + 1, F.greatest(F.size(found) - skip, F.lit(0)))
    cells = F.transform(kept_cells, direct_else_child)
    padded = F.when(F.size("_cells") == width, F.col("_cells")).otherwise(
        F.concat("_cells", F.array(F.lit(MISSING_CELL)))
    )
    return rows.withColumn("_cells", cells).select(*kept, position, padded.alias(name))


def not_processed(
    pages: DataFrame, stored: DataFrame, key: str, required: str | None = None
) -> DataFrame:
    """Pages not stored yet, leaving out those whose ``required`` column is empty."""
    if required:
        pages = pages.filter(F.col(required) != "")
    return pages.join(stored.select(key), key, "left_anti")


# Markup of the pages. A listing page has one entry per player, a
# player page one row per season, a game-log page one row per game.
LISTING = {
    "name": r'<th[^<>]*data-stat="player"[^<>]*>(?:<strong>)?<a[^<>]*>([^<]*)</a>',
    "player_id": r'data-append-csv="([^"]*)"',
    "college": r'<td[^<>]*data-stat="college_name"[^<>]*>(?:<a[^<>]*>([^<]*))?',
    "debut": r'<td[^<>]*data-stat="year_min"[^<>]*>([^<]*)',
    "last": r'<td[^<>]*data-stat="year_max"[^<>]*>([^<]*)',
}
SEASON_CELL = {
    "games_played": "g",
    "played_minutes": "mp_per_g",
    "field_goals": "fg_per_g",
    "field_goals_attempted": "fga_per_g",
    "field_goals_percentage": "fg_pct",
    "three_field_goals": "fg3_per_g",
    "three_field_goals_attempted": "fg3a_per_g",
    "three_field_goals_percentage": "fg3_pct",
    "two_field_goals": "fg2_per_g",
    "two_field_goals_attempted": "fg2a_per_g",
    "two_field_goals_percentage": "fg2_pct",
    "effective_field_goals_percentage": "efg_pct",
    "free_throws": "ft_per_g",
    "free_throws_attempted": "fta_per_g",
    "free_throws_percentage": "ft_pct",
    "offensive_rebounds": "orb_per_g",
    "defensive_rebounds": "drb_per_g",
    "total_rebounds": "trb_per_g",
    "assists": "ast_per_g",
    "steals": "stl_per_g",
    "blocks": "blk_per_g",
    "turnovers": "tov_per_g",
    "personal_fouls": "pf_per_g",
    "points": "pts_per_g",
}
SEASON_ROW = r'(?s)<tr[^<>]*id="per_game\.([^"]*)"[^<>]*>(.*?)</tr>'
GAME_ROW = r'(?s)<tr[^<>]*id="[^"]*pgl_basic[^"]*"[^<>]*>(.*?)</tr>'
GAME_CELL = r"(?s)<t[dh][^<>]*>.*?</t[dh]>"


def listing_players(df: DataFrame, html: str = "html") -> DataFrame:
    """Players of listing pages: name, id, college, first and last year."""
    return list_entries(df, html, LISTING, lead="name")


def season_rows(df: DataFrame, html: str = "html", season: str = "season_end") -> DataFrame:
    """All season rows of player pages: the other columns, ``season`` and ``rows`` (their markup).

    A page is searched once, and its text is not copied: only the rows found leave it. Rows
    of the same season are joined to one text.
    """
    kept = [c for c in df.columns if c != html]
    found = F.arrays_zip(
        matches(F.col(html), SEASON_ROW, 1).alias("id"), matches(F.col(html), SEASON_ROW, 2).alias("row")
    )
    seasons = F.array_distinct(F.transform("_found", lambda x: x["id"]))
    rows = df.withColumn("_found", found).select(*kept, "_found", F.explode(seasons).alias("_id"))
    of_season = F.filter("_found", lambda x: x["id"] == F.col("_id"))
    text = F.array_join(F.transform(of_season, lambda x: x["row"]), "")
    return rows.select(*kept, F.col("_id").try_cast("int").alias(season), text.alias("rows"))


def season_cells(df: DataFrame, rows: str = "rows") -> DataFrame:
    """The 24 statistics of one season of a player page, as text; NULL where absent."""

    def cell(tag: str) -> Column:
        found = matches(F.col(rows), rf'(?s)<td[^<>]*data-stat="{tag}"[^<>]*>.*?</td>', 0)
        first, second = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        strong = F.regexp_extract(first, r"<strong>([^<]*)", 1)
        own = F.regexp_extract(F.coalesce(second, first), _LEADING_TEXT, 1)
        return F.nullif(F.when(first.contains("<strong>"), strong).otherwise(own), F.lit(""))

    kept = [c for c in df.columns if c != rows]
    return df.select(*kept, *[cell(tag).alias(stat) for stat, tag in SEASON_CELL.items()])


def game_rows(df: DataFrame, html: str = "html", width: int = 29) -> DataFrame:
    """Game rows of game-log pages, as arrays of cell texts without the leading rank."""
    return row_cells(df, html, GAME_ROW, GAME_CELL, width, skip=1)
