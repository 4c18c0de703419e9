"""Column names of the input files and of the tables derived from them."""

from pyspark.sql import types as T

# The statistics kept per entity and period. The first 24 come from
# the season file, the last two are derived from the games.
STATS = (
    "games_played",
    "played_minutes",
    "field_goals",
    "field_goals_attempted",
    "field_goals_percentage",
    "three_field_goals",
    "three_field_goals_attempted",
    "three_field_goals_percentage",
    "two_field_goals",
    "two_field_goals_attempted",
    "two_field_goals_percentage",
    "effective_field_goals_percentage",
    "free_throws",
    "free_throws_attempted",
    "free_throws_percentage",
    "offensive_rebounds",
    "defensive_rebounds",
    "total_rebounds",
    "assists",
    "steals",
    "blocks",
    "turnovers",
    "personal_fouls",
    "points",
    "game_score",
    "plus_minus",
)
FILE_STATS = STATS[:24]
GAME_MEANS = STATS[24:]

# Header text -> column name, in file order.
PLAYER_FILE = {
    "ID": "player_id",
    "NAME": "name",
    "COLLEGE": "college",
    "STATE": "state",
    "FROM": "debut",
    "TO": "last",
}

SEASON_FILE = {
    "PLAYER_ID": "player_id",
    "SEASON": "season",
    "GAMES_PLAYED": "games_played",
    "PLAYED_MINUTES": "played_minutes",
    "FIELD_GOALS": "field_goals",
    "FIELD_GOALS_ATTEMPTED": "field_goals_attempted",
    "FIELD_GOALS_PERCENTAGE": "field_goals_percentage",
    "3_FIELD_GOALS": "three_field_goals",
    "3_FIELD_GOALS_ATTEMPTED": "three_field_goals_attempted",
    "3_FIELD_GOALS_PERCENTAGE": "three_field_goals_percentage",
    "2_FIELD_GOALS": "two_field_goals",
    "2_FIELD_GOALS_ATTEMPTED": "two_field_goals_attempted",
    "2_FIELD_GOALS_PERCENTAGE": "two_field_goals_percentage",
    "EFFECTIVE_FIELD_GOALS_PERCENTAGE": "effective_field_goals_percentage",
    "FREE_THROWS": "free_throws",
    "FREE_THROWS_ATTEMPTED": "free_throws_attempted",
    "FREE_THROWS_PERCENTAGE": "free_throws_percentage",
    "OFFENSIVE_REBOUNDS": "offensive_rebounds",
    "DEFENSIVE_REBOUNDS": "defensive_rebounds",
    "TOTAL_REBOUNDS": "total_rebounds",
    "ASSISTS": "assists",
    "STEALS": "steals",
    "BLOCKS": "blocks",
    "TURNOVERS": "turnovers",
    "PERSONAL_FOULS": "personal_fouls",
    "POINTS": "points",
}

GAME_FILE = {
    "PLAYER_ID": "player_id",
    "SEASON": "season",
    "SEASON GAME": "season_game",
    "DATE": "date",
    "AGE_OF_PLAYER": "age_of_player",
    "TEAM": "team",
    "AT": "at",
    "OPPONENT": "opponent",
    "RESULT_GAME": "result_game",
    "GAMES_STARTED": "games_started",
    "MINUTES_PLAYED": "minutes_played",
    "FIELD_GOALS": "field_goals",
    "FIELD_GOAL_ATTEMPTS": "field_goal_attempts",
    "FIELD_GOAL_PERCENTAGE": "field_goal_percentage",
    "3-POINT_FIELD_GOALS": "three_point_field_goals",
    "3-POINT_FIELD_GOAL_ATTEMPTS": "three_point_field_goal_attempts",
    "3-POINT_FIELD_GOAL_PERCENTAGE": "three_point_field_goal_percentage",
    "FREE_THROWS": "free_throws",
    "FREE_THROWS_ATTEMPTS": "free_throws_attempts",
    "FREE_THROW_PERCENTAGE": "free_throws_percentage",
    "OFFENSIVE_REBOUNDS": "offensive_rebounds",
    "DEFENSIVE_REBOUNDS": "defensive_rebounds",
    "TOTAL_REBOUNDS": "total_rebounds",
    "ASSISTS": "assists",
    "STEALS": "steals",
    "BLOCKS": "blocks",
    "TURNOVERS": "turnovers",
    "PERSONAL_FOULS": "personal_fouls",
    "POINTS": "points",
    "GAME_SCORE": "game_score",
    "PLUS/MINUS": "plus_minus",
}

# Read from the game file but not kept in the documents.
GAME_FIELDS_NOT_STORED = (
    "at",
    "result_game",
    "three_point_field_goals",
    "three_point_field_goal_attempts",
    "three_point_field_goal_percentage",
)
GAME_FIELDS = tuple(
    c
    for c in GAME_FILE.values()
    if c not in ("player_id", "season", "season_game", *GAME_FIELDS_NOT_STORED)
)


def text_schema(columns) -> T.StructType:
    """All-text schema: files are read as text and cast once afterwards."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _score_file(*columns: str, text: tuple[str, ...]) -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.StringType() if c in text else T.DoubleType()) for c in columns]
    )


# Columns of the score files, which have no header row.
GROUP_FILE = _score_file(
    "name",
    "state",
    "state_abbreviation",
    "score",
    "players",
    text=("name", "state", "state_abbreviation"),
)
REGION_FILE = _score_file(
    "name", "state_abbreviation", "score", "players", text=("name", "state_abbreviation")
)
CATEGORY_FILE = _score_file("name", "score", text=("name",))
ALUMNI_FILE = _score_file("name", "score", "alumni", text=("name",))
