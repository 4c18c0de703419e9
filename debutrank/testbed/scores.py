"""Profiles, scores, rankings and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from debutrank.categories import CATEGORIES, category
from debutrank.functions.cells import MISSING_GROUP, MISSING_REGION
from debutrank.functions.scores import (
    COMPARISONS,
    bonus_term,
    minmax,
    thresholds_hold,
    weighted_sum,
)
from debutrank.operators import ranking, rollup
from debutrank.operators.profile import OPS, profile_long
from debutrank.operators.scoring import (
    long_scores,
    needed_measures,
    score_columns,
    score_entities,
)
from debutrank.plans import presentation, rankings
from debutrank.plans.populate import Tables
from debutrank.schemas import STATS
from debutrank.session import shared_path, written
from debutrank.testbed.registry import Registry, number, snap, snap_sql
from debutrank.testbed.score_sql import (
    condition,
    presented,
    rescaled,
    score_ctes,
    weighted,
)
from debutrank.testbed.seasons import (
    MEMBERS_CTE,
    SEASON_CTE,
    build_seasons,
    members,
    nations,
    profile_cte,
    season_profile,
    seasons,
    table,
)

R = Registry()
COLUMNS = score_columns(CATEGORIES)
SHORTS = [c.short for c in CATEGORIES]
# Variances are of a larger scale than the other measures.
_SCALE = {"mean": ("1e4", 1e4), "variance": ("1e2", 1e2), "max": ("1e4", 1e4), "min": ("1e4", 1e4)}


@R.query(
    "season_table",
    "WITH"
    + SEASON_CTE
    + " SELECT entity, CAST(period AS INTEGER) AS period, "
    + ", ".join(f"{snap_sql(s)} AS {s}" for s in STATS)
    + " FROM seasons",
)
def season_table(spark, sf_dir):
    rows = build_seasons(spark, sf_dir)
    return rows.select("entity", "period", *[snap(s).alias(s) for s in STATS])


def _profile_query(op):
    sql = (
        "WITH"
        + SEASON_CTE
        + ","
        + profile_cte([f"{s}_{op}" for s in STATS])
        + " SELECT CAST(period AS INTEGER) AS period, "
        + ", ".join(f"{snap_sql(f'{s}_{op}', _SCALE[op][0])} AS {s}" for s in STATS)
        + " FROM profile"
    )

    @R.query(f"profile_{op}", sql)
    def run(spark, sf_dir):
        rows = season_profile(spark, sf_dir)
        return rows.select(
            "period", *[snap(f"{s}_{op}", _SCALE[op][1]).alias(s) for s in STATS]
        )


for _op in OPS:
    _profile_query(_op)


@R.query(
    "profile_long",
    "WITH"
    + SEASON_CTE
    + ","
    + profile_cte([f"{s}_{op}" for s in STATS for op in OPS])
    + " "
    + " UNION ALL ".join(
        f"SELECT CAST(period AS INTEGER) AS period, '{s}' AS stat, "
        + ", ".join(f"{snap_sql(f'{s}_{op}', _SCALE[op][0])} AS {op}" for op in OPS)
        + " FROM profile"
        for s in STATS
    ),
)
def profile_as_rows(spark, sf_dir):
    rows = profile_long(season_profile(spark, sf_dir))
    return rows.select(
        "period", "stat", *[snap(op, _SCALE[op][1]).alias(op) for op in OPS]
    )


# --- parts of the score ----------------------------------------------------------


def _with_profile(spark, sf_dir, measures):
    profile = season_profile(spark, sf_dir).select("period", *measures)
    return seasons(spark, sf_dir).join(profile, "period")


def _joined_sql(measures):
    return "WITH" + SEASON_CTE + "," + profile_cte(measures) + " "


_JOIN = "FROM seasons JOIN profile USING (period)"
_KEY_SQL = "entity, CAST(period AS INTEGER) AS period"


def _mean(stat):
    return F.col(f"{stat}_mean")


_ATT = category("attackers")
_DEF = category("defenders")


@R.query(
    "threshold_filter",
    _joined_sql(needed_measures([_ATT])) + f"SELECT {_KEY_SQL} {_JOIN} WHERE {condition(_ATT)}",
)
def threshold_filter(spark, sf_dir):
    rows = _with_profile(spark, sf_dir, needed_measures([_ATT]))
    return rows.filter(thresholds_hold(_ATT.thresholds, F.col, _mean)).select("entity", "period")


_OP_NAMES = {">=": "ge", ">": "gt", "<=": "le", "<": "lt", "==": "eq", "!=": "ne"}


@R.query(
    "threshold_ops",
    _joined_sql(["blocks_mean"])
    + f"SELECT {_KEY_SQL}, "
    + ", ".join(
        f"CAST(blocks {op} blocks_mean * 0.5e0 AS INTEGER) AS {name}"
        for op, name in _OP_NAMES.items()
    )
    + " "
    + _JOIN,
)
def threshold_ops(spark, sf_dir):
    rows = _with_profile(spark, sf_dir, ["blocks_mean"])
    limit = _mean("blocks") * F.lit(0.5)
    return rows.select(
        "entity",
        "period",
        *[
            COMPARISONS[op](F.col("blocks"), limit).cast("int").alias(name)
            for op, name in _OP_NAMES.items()
        ],
    )


_BONUS = _DEF.bonuses[0]


@R.query(
    "bonus_term",
    _joined_sql(["personal_fouls_mean"])
    + f"SELECT {_KEY_SQL}, "
    + snap_sql(
        f"({number(_BONUS.weight)} * (personal_fouls - personal_fouls_mean) * {number(_BONUS.sign)})"
    )
    + f" AS bonus {_JOIN}",
)
def bonus(spark, sf_dir):
    rows = _with_profile(spark, sf_dir, ["personal_fouls_mean"])
    term = bonus_term(_BONUS, F.col(_BONUS.stat), _mean(_BONUS.stat))
    return rows.select("entity", "period", snap(term).alias("bonus"))


@R.query(
    "weighted_score",
    "WITH"
    + SEASON_CTE
    + f" SELECT {_KEY_SQL}, "
    + ", ".join(f"{snap_sql('(' + weighted(c) + ')')} AS {c.short}" for c in CATEGORIES)
    + " FROM seasons",
)
def weighted_score(spark, sf_dir):
    return seasons(spark, sf_dir).select(
        "entity",
        "period",
        *[snap(weighted_sum(c.weights, F.col)).alias(c.short) for c in CATEGORIES],
    )


_SCALED = ("points", "steals", "plus_minus")
_BOUNDS = [f"{s}_{op}" for s in _SCALED for op in ("max", "min")]


@R.query(
    "minmax_by_season",
    _joined_sql(_BOUNDS)
    + f"SELECT {_KEY_SQL}, "
    + ", ".join(
        f"{snap_sql(f'(({s} - {s}_min) / nullif({s}_max - {s}_min, 0))')} AS {s}" for s in _SCALED
    )
    + " "
    + _JOIN,
)
def minmax_by_season(spark, sf_dir):
    rows = _with_profile(spark, sf_dir, _BOUNDS)
    return rows.select(
        "entity",
        "period",
        *[snap(minmax(F.col(s), F.col(f"{s}_min"), F.col(f"{s}_max"))).alias(s) for s in _SCALED],
    )


# --- rankings per category -------------------------------------------------------


def _group_ctes(categories, scaled=False):
    sums = ", ".join(f"sum({c.short}_score) AS {c.short}_score" for c in categories)
    return (
        score_ctes(categories, scaled)
        + ","
        + MEMBERS_CTE
        + f""",
grouped AS (
  SELECT coalesce(grp, 'null') AS grp, {sums}, count(*) AS members
  FROM scores LEFT JOIN members USING (entity) GROUP BY 1
)"""
    )


def _rank_queries(c):
    column = f"{c.short}_score"

    @R.query(
        f"player_score_{c.short}",
        score_ctes([c])
        + f" SELECT entity, {snap_sql('(' + rescaled(column, 'scores') + ')')} AS score FROM scores",
    )
    def entities(spark, sf_dir):
        ranked = rankings.rank_entities(seasons(spark, sf_dir), season_profile(spark, sf_dir), c)
        return ranked.withColumn("score", snap("score"))

    @R.query(
        f"group_score_{c.short}",
        _group_ctes([c])
        + f" SELECT grp, {snap_sql('(' + rescaled(column, 'grouped') + ')', '1e3')} AS score, "
        "members FROM grouped",
    )
    def groups(spark, sf_dir):
        ranked = rankings.rank_groups(
            seasons(spark, sf_dir), season_profile(spark, sf_dir), members(spark, sf_dir), c
        )
        return ranked.withColumn("score", snap("score", 1e3))


for _category in CATEGORIES:
    _rank_queries(_category)


@R.query(
    "player_score_scaled_att",
    score_ctes([_ATT], scaled=True)
    + f" SELECT entity, {snap_sql('(' + rescaled('att_score', 'scores') + ')')} AS score FROM scores",
)
def player_score_scaled(spark, sf_dir):
    ranked = rankings.rank_entities(
        seasons(spark, sf_dir), season_profile(spark, sf_dir), _ATT, scaled=True
    )
    return ranked.withColumn("score", snap("score"))


@R.query(
    "group_score_scaled_att",
    _group_ctes([_ATT], scaled=True)
    + f" SELECT grp, {snap_sql('(' + rescaled('att_score', 'grouped') + ')', '1e3')} AS score, "
    "members FROM grouped",
)
def group_score_scaled(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    ranked = rankings.run(tables, "attackers", groups=True, scaled=True)
    return ranked.withColumn("score", snap("score", 1e3))


def _tables(spark, sf_dir):
    return Tables(seasons(spark, sf_dir), season_profile(spark, sf_dir), members(spark, sf_dir))


# Every third season lacks what the attackers and defenders are weighted and tested by.
_GAPS = sorted(set(_ATT.stats) | set(_DEF.stats))


@R.query(
    "player_score_missing",
    score_ctes([_ATT, _DEF]).replace(
        "marks AS (",
        "gaps AS (SELECT * REPLACE ("
        + ", ".join(f"CASE WHEN entity % 3 = 0 THEN 0e0 ELSE {s} END AS {s}" for s in _GAPS)
        + ") FROM seasons),\nmarks AS (",
    ).replace("FROM seasons JOIN profile", "FROM gaps JOIN profile")
    + f" SELECT entity, {snap_sql('att_score')} AS att_score, {snap_sql('def_score')} AS def_score "
    "FROM scores",
)
def player_score_missing(spark, sf_dir):
    """A missing statistic is scored as 0 (the profile is that of the whole table)."""
    rows = seasons(spark, sf_dir)
    gaps = rows.withColumns({s: F.when(F.col("entity") % 3 != 0, F.col(s)) for s in _GAPS})
    scores = score_entities(gaps, season_profile(spark, sf_dir), [_ATT, _DEF])
    return scores.select("entity", snap("att_score").alias("att_score"), snap("def_score").alias("def_score"))


def _raw_scores(spark, sf_dir, categories=CATEGORIES):
    return score_entities(seasons(spark, sf_dir), season_profile(spark, sf_dir), categories)


@R.query(
    "join_score_group",
    score_ctes([_ATT])
    + ","
    + MEMBERS_CTE
    + f" SELECT entity, coalesce(grp, 'null') AS grp, {snap_sql('att_score')} AS score "
    "FROM scores LEFT JOIN members USING (entity)",
)
def join_score_group(spark, sf_dir):
    rows = ranking.with_group(_raw_scores(spark, sf_dir, [_ATT]), members(spark, sf_dir))
    return rows.select("entity", "grp", snap("att_score").alias("score"))


@R.query(
    "global_extrema",
    score_ctes(CATEGORIES)
    + " SELECT "
    + ", ".join(
        f"{snap_sql(f'{f}({c})')} AS {c}_{f}" for c in COLUMNS for f in ("max", "min")
    )
    + " FROM scores",
)
def global_extrema(spark, sf_dir):
    rows = ranking.extrema(_raw_scores(spark, sf_dir), COLUMNS)
    return rows.select(*[snap(c).alias(c) for c in rows.columns])


# Rescaling alone, on account balances (which are negative for some customers).
@R.query(
    "rescale_players",
    f"SELECT c_custkey AS entity, {snap_sql('(' + rescaled('c_acctbal', 'customer') + ')')} "
    "AS score FROM customer",
)
def rescale_players(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_acctbal").alias("score")
    )
    return ranking.rescale(rows, "score").withColumn("score", snap("score"))


@R.query(
    "rescale_groups",
    f"""WITH grouped AS (SELECT c_nationkey AS grp,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2)) - 4500) AS DOUBLE) AS score, count(*) AS members
  FROM customer GROUP BY 1)
SELECT grp, {snap_sql('(' + rescaled('score', 'grouped') + ')')} AS score, members FROM grouped""",
)
def rescale_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("grp"),
        (F.col("c_acctbal").cast("decimal(18,2)") - F.lit(4500)).alias("score"),
    )
    grouped = ranking.group_sum_count(rows, "grp", "score")
    grouped = grouped.withColumn("score", F.col("score").cast("double"))
    return ranking.rescale_written(grouped, "score", "balances").withColumn("score", snap("score"))


@R.query(
    "rescale_columns",
    "SELECT p_partkey, "
    + ", ".join(
        f"{snap_sql('(' + presented(c, 'part') + ')')} AS {c}" for c in ("p_retailprice", "p_size")
    )
    + " FROM part",
)
def rescale_columns(spark, sf_dir):
    columns = ["p_retailprice", "p_size"]
    rows = table(spark, sf_dir, "part").select("p_partkey", *columns)
    out = ranking.rescale_columns(rows, columns)
    return out.select("p_partkey", *[snap(c).alias(c) for c in columns])


# --- all categories --------------------------------------------------------------


def _ranked_cte(source, name, key, extra=""):
    columns = ", ".join(f"{rescaled(c, source)} AS {c}" for c in COLUMNS)
    return f",\n{name} AS (SELECT {key}, {columns}{extra} FROM {source})"


_ENTITIES = score_ctes(CATEGORIES) + _ranked_cte("scores", "ranked", "entity")
_GROUPS = _group_ctes(CATEGORIES) + _ranked_cte("grouped", "ranked_groups", "grp", ", members")


def _long_sql(source, keys, scale):
    return " UNION ALL ".join(
        f"SELECT {keys}, '{s}' AS category, {snap_sql(f'{s}_score', scale)} AS score FROM {source}"
        for s in SHORTS
    )


def _ranked(spark, sf_dir):
    return rankings.rank_entities_all(seasons(spark, sf_dir), season_profile(spark, sf_dir))


def _ranked_groups(spark, sf_dir):
    return rankings.rank_groups_all(
        seasons(spark, sf_dir), season_profile(spark, sf_dir), members(spark, sf_dir)
    )


_SCALED_ENTITIES = score_ctes(CATEGORIES, True) + _ranked_cte("scores", "ranked", "entity")


@R.query("all_categories_scaled", _SCALED_ENTITIES + " " + _long_sql("ranked", "entity", "1e4"))
def all_categories_scaled(spark, sf_dir):
    rows = rankings.run(_tables(spark, sf_dir), "all", scaled=True)
    return rows.withColumn("score", snap("score"))


@R.query(
    "score_files_roundtrip",
    _group_ctes(CATEGORIES)
    + ",\nnamed AS (SELECT * FROM grouped WHERE grp <> 'null')"
    + _ranked_cte("named", "ranked_groups", "grp", ", members")
    + " "
    + " UNION ALL ".join(
        f"SELECT grp AS name, '{s}' AS category, {snap_sql(f'{s}_score', '1e3')} AS score, "
        "members FROM ranked_groups"
        for s in SHORTS
    ),
)
def score_files_roundtrip(spark, sf_dir):
    """Group rankings without the group ``null``, as score files and read back."""
    folder = shared_path(spark, "score-files")
    paths = rankings.write_score_files(_tables(spark, sf_dir), folder, groups=True, without_missing=True)
    rows = rankings.read_score_files(spark, paths, groups=True)
    return rows.withColumn("score", snap("score", 1e3))


@R.query("all_categories_players", _ENTITIES + " " + _long_sql("ranked", "entity", "1e4"))
def all_categories_players(spark, sf_dir):
    rows = long_scores(_ranked(spark, sf_dir), ["entity"], CATEGORIES)
    return rows.withColumn("score", snap("score"))


@R.query(
    "all_categories_groups", _GROUPS + " " + _long_sql("ranked_groups", "grp, members", "1e3")
)
def all_categories_groups(spark, sf_dir):
    rows = long_scores(_ranked_groups(spark, sf_dir), ["grp", "members"], CATEGORIES)
    return rows.withColumn("score", snap("score", 1e3))


@R.query(
    "merge_categories",
    _ENTITIES
    + f""" SELECT c_custkey AS entity, c_name AS name,
  {", ".join(f"{snap_sql(c)} AS {c}" for c in COLUMNS)}
FROM customer LEFT JOIN ranked ON c_custkey = entity""",
)
def merge_categories(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_name").alias("name")
    )
    scores = long_scores(_ranked(spark, sf_dir), ["entity"], CATEGORIES)
    merged = rollup.merge_categories(base, scores, "entity", SHORTS)
    return merged.select("entity", "name", *[snap(c).alias(c) for c in COLUMNS])


def _presented_cte(source, name, key):
    columns = ", ".join(f"{presented(c, source)} AS {c}" for c in COLUMNS)
    total = " + ".join(f"coalesce({c}, 0)" for c in COLUMNS)
    return (
        f",\n{name}_aspects AS (SELECT {key}, {columns} FROM {source}),\n"
        f"{name} AS (SELECT *, {total} AS score FROM {name}_aspects)"
    )


def _snapped_sql(scale="1e3"):
    return ", ".join(f"{snap_sql(c, scale)} AS {c}" for c in [*COLUMNS, "score"])


def _snapped(rows, *keys):
    return rows.select(*keys, *[snap(c, 1e3).alias(c) for c in [*COLUMNS, "score"]])


@R.query(
    "total_players",
    _ENTITIES
    + _presented_cte("ranked", "totals", "entity")
    + f" SELECT entity, {_snapped_sql()} FROM totals",
)
def total_players(spark, sf_dir):
    return _snapped(presentation.entity_totals(_ranked(spark, sf_dir), COLUMNS), "entity")


@R.query(
    "total_groups",
    _GROUPS
    + _presented_cte("ranked_groups", "totals", "grp")
    + f" SELECT grp, {_snapped_sql()} FROM totals",
)
def total_groups(spark, sf_dir):
    return _snapped(presentation.group_totals(_ranked_groups(spark, sf_dir), COLUMNS), "grp")


_REGION_SUMS = ", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in [*COLUMNS, "score"])
_ROLLED = (
    _GROUPS
    + _presented_cte("ranked_groups", "totals", "grp")
    + f""",
places AS (SELECT n_name AS grp, r_name AS region FROM nation
  JOIN region ON n_regionkey = r_regionkey),
rolled AS (SELECT r_name AS region, {_REGION_SUMS} FROM region
  LEFT JOIN (SELECT totals.*, region FROM totals JOIN places USING (grp)) ON region = r_name
  GROUP BY 1)"""
)


def _regions_and_groups(spark, sf_dir):
    places = nations(spark, sf_dir).select(
        F.col("n_name").alias("grp"), F.col("r_name").alias("region")
    )
    groups = presentation.group_totals(_ranked_groups(spark, sf_dir), COLUMNS).join(places, "grp")
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("region"))
    return regions, groups


@R.query("state_rollup", _ROLLED + f" SELECT region, {_snapped_sql()} FROM rolled")
def state_rollup(spark, sf_dir):
    regions, groups = _regions_and_groups(spark, sf_dir)
    rolled = rollup.roll_up(regions, groups, "region", [*COLUMNS, "score"])
    return _snapped(rolled, "region")


@R.query(
    "state_scores",
    _ROLLED
    + _presented_cte("rolled", "states", "region")
    + f" SELECT region, {_snapped_sql()} FROM states",
)
def state_scores(spark, sf_dir):
    regions, groups = _regions_and_groups(spark, sf_dir)
    return _snapped(presentation.region_totals(regions, groups, "region", COLUMNS), "region")


# --- top lists and drill-down ------------------------------------------------------


@R.query(
    "top10_players",
    score_ctes([_ATT])
    + f""",
snapped AS (SELECT entity, {snap_sql('(' + rescaled('att_score', 'scores') + ')')} AS score
  FROM scores)
SELECT entity, c_name AS name, score FROM snapped LEFT JOIN customer ON entity = c_custkey
ORDER BY score DESC, entity LIMIT 10""",
)
def top10_players(spark, sf_dir):
    best = ranking.top_k(
        R.queries["player_score_att"](spark, sf_dir), 10, "score", ["entity"]
    )
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_name").alias("name")
    )
    # Ten rows: the names stay where they are, those of the ten are found without a shuffle.
    found = names.join(F.broadcast(best.select("entity")), "entity", "left_semi")
    return best.join(found, "entity", "left").select("entity", "name", "score")


@R.query(
    "top10_groups",
    _GROUPS
    + _presented_cte("ranked_groups", "totals", "grp")
    + f""" SELECT grp, {snap_sql("score", "1e3")} AS score FROM totals
ORDER BY score DESC, grp LIMIT 10""",
)
def top10_groups(spark, sf_dir):
    rows = total_groups(spark, sf_dir).select("grp", "score")
    return ranking.top_k(rows, 10, "score", ["grp"])


@R.query(
    "topk_per_category",
    _ENTITIES
    + f""",
long AS ({_long_sql("ranked", "entity", "1e4")})
SELECT category, entity, score, CAST(rank AS INTEGER) AS rank FROM
  (SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC, entity) AS rank
   FROM long) WHERE rank <= 10""",
)
def topk_per_category(spark, sf_dir):
    rows = all_categories_players(spark, sf_dir)
    return ranking.top_k_per(rows, "category", 10, "score", ["entity"])


@R.query(
    "drilldown",
    _ROLLED
    + _ranked_cte("scores", "ranked", "entity")
    + _presented_cte("rolled", "states", "region")
    + f""" SELECT coalesce(places.region, CASE WHEN members.grp IS NULL THEN 'null' ELSE 'no state' END)
    AS region, {snap_sql("states.score", "1e3")} AS region_score, coalesce(members.grp, 'null') AS grp,
  {snap_sql("totals.score", "1e3")} AS grp_score, seasons.entity, members.name,
  {snap_sql("ranked.att_score")} AS entity_score, CAST(seasons.period AS INTEGER) AS period,
  {snap_sql("seasons.points")} AS points
FROM seasons JOIN ranked USING (entity) LEFT JOIN members USING (entity)
LEFT JOIN totals ON totals.grp = coalesce(members.grp, 'null')
LEFT JOIN places ON places.grp = members.grp
LEFT JOIN states ON states.region = places.region""",
)
def drilldown(spark, sf_dir):
    """Every ranked entity and season; what has no group or region has the labels for that."""
    people = members(spark, sf_dir)
    raw = written(_raw_scores(spark, sf_dir), "scores")
    ranked_groups = rankings.rank_groups_of(raw, people, COLUMNS)
    totals = written(presentation.group_totals(ranked_groups, COLUMNS), "group-totals")
    places = nations(spark, sf_dir).select(
        F.col("n_name").alias("grp"), F.col("r_name").alias("region")
    )
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("region"))
    states = presentation.region_totals(regions, totals.join(places, "grp"), "region", COLUMNS)
    groups = (
        totals.select("grp", F.col("score").alias("grp_score"))
        .join(places, "grp", "left")
        .join(states.select("region", F.col("score").alias("region_score")), "region", "left")
    )
    ranked = ranking.with_group(
        ranking.rescale(raw, COLUMNS).select("entity", "att_score"), people.select("entity", "grp")
    )
    return (
        seasons(spark, sf_dir)
        .select("entity", "period", "points")
        .join(ranked, "entity")
        .join(people.select("entity", "name"), "entity", "left")
        .join(groups, "grp", "left")
        .withColumn("region", F.coalesce("region", F.when(F.col("grp") == MISSING_GROUP, MISSING_GROUP).otherwise(MISSING_REGION)))
        .select(
            "region",
            snap("region_score", 1e3).alias("region_score"),
            "grp",
            snap("grp_score", 1e3).alias("grp_score"),
            "entity",
            "name",
            snap("att_score").alias("entity_score"),
            "period",
            snap("points").alias("points"),
        )
    )
