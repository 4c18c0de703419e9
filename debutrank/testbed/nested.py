"""Nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from debutrank.operators import documents as docs
from debutrank.operators.dedupe import dedupe_last
from debutrank.operators.runs import run_of_map
from debutrank.plans.populate import numbered_documents
from debutrank.schemas import STATS
from debutrank.session import shared_path
from debutrank.sources import store
from debutrank.testbed.registry import Registry, snap, snap_sql
from debutrank.testbed.relations import _LINE_KEY, _LINE_ORDER, _deduped_sql
from debutrank.testbed.seasons import MEMBERS_CTE, SEASON_CTE, _once, members, seasons, table

R = Registry()
_FIELDS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_KEYS = ["player_id", "college", "state", "number"]


def build_documents(spark, sf_dir):
    """One document per customer: years, their order lines (last wins) and statistics."""
    lines = dedupe_last(table(spark, sf_dir, "lineitem"), _LINE_KEY, _LINE_ORDER)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    games = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("entity"),
        F.year("o_orderdate").alias("period"),
        F.concat_ws("-", *_LINE_KEY).alias("game"),
        *_FIELDS,
    )
    rows = seasons(spark, sf_dir)
    nested = docs.nest(games, rows, "entity", "period", "game", _FIELDS, STATS)
    # every order line with an order is in a season, so these are the entities of all documents
    return numbered_documents(nested, members(spark, sf_dir), entities=rows.select("entity").distinct())


def documents(spark, sf_dir):
    return _once(spark, sf_dir, "documents", lambda: build_documents(spark, sf_dir))


def entries(spark, sf_dir):
    """The same documents, stored by column once per session."""
    return _once(spark, sf_dir, "entries", lambda: docs.as_entries(documents(spark, sf_dir)))


def _flat(rows):
    """Per customer and period: number of games, sums of all their fields, all statistics."""
    values = F.map_values("games")

    def total(field):
        exact = F.transform(values, lambda g: g[field].cast("decimal(18,4)"))
        sums = F.aggregate(exact, F.lit(0).cast("decimal(28,4)"), lambda a, x: (a + x).cast("decimal(28,4)"))
        return sums.cast("double").alias(field)

    return docs.explode_seasons(rows, _KEYS).select(
        *_KEYS,
        "period",
        F.size("games").alias("games"),
        *[total(f) for f in _FIELDS],
        *[snap(f"all.{s}").alias(s) for s in STATS],
    )


_PEOPLE = (
    MEMBERS_CTE
    + """,
people AS (SELECT e.entity, coalesce(grp, 'null') AS grp,
    CASE WHEN grp IS NULL THEN 'null' ELSE coalesce(region, 'no state') END AS region,
    row_number() OVER (ORDER BY e.entity) - 1 AS number
  FROM (SELECT DISTINCT o_custkey AS entity FROM orders JOIN lineitem ON l_orderkey = o_orderkey) e
  LEFT JOIN members USING (entity))"""
)
_SUMS = ", ".join(
    f"CAST(sum(CAST({f} AS DECIMAL(18,4))) AS DOUBLE) AS {f}" for f in _FIELDS
)
_GAMES = f""",
games AS (SELECT o_custkey AS entity, year(o_orderdate) AS period, count(*) AS games, {_SUMS}
  FROM ({_deduped_sql("DESC")}) JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
_FLAT_SQL = (
    "WITH"
    + SEASON_CTE
    + ","
    + _PEOPLE
    + _GAMES
    + f""" SELECT entity AS player_id, grp AS college, region AS state, number,
  CAST(period AS INTEGER) AS period, CAST(games.games AS INTEGER) AS games,
  {", ".join(f"games.{f}" for f in _FIELDS)}, {", ".join(f"{snap_sql(s)} AS {s}" for s in STATS)}
FROM games JOIN seasons USING (entity, period) JOIN people USING (entity)"""
)


@R.query("nest_documents", _FLAT_SQL)
def nest_documents(spark, sf_dir):
    return _flat(build_documents(spark, sf_dir))


@R.query("scan_documents", _FLAT_SQL)
def scan_documents(spark, sf_dir):
    """Whole documents, from the store by column."""
    return _flat(docs.as_maps(entries(spark, sf_dir)))


@R.query("sink_documents", _FLAT_SQL)
def sink_documents(spark, sf_dir):
    rows = documents(spark, sf_dir)
    path = shared_path(spark, "documents-json")
    store.write_documents(rows, path)
    return _flat(store.read_documents(spark, path, rows.schema))


@R.query(
    "explode_seasons",
    "WITH"
    + SEASON_CTE
    + " SELECT entity AS player_id, CAST(period AS INTEGER) AS period, "
    + ", ".join(f"{snap_sql(s)} AS {s}" for s in STATS)
    + " FROM seasons",
)
def explode_seasons(spark, sf_dir):
    rows = docs.season_rows(documents(spark, sf_dir), ["player_id"])
    return rows.select("player_id", "period", *[snap(s).alias(s) for s in STATS])


@R.query(
    "scan_project",
    "WITH"
    + SEASON_CTE
    + ","
    + _PEOPLE
    + """ SELECT entity AS player_id, grp AS college, region AS state,
  CAST(count(*) AS INTEGER) AS seasons FROM seasons JOIN people USING (entity)
GROUP BY entity, grp, region""",
)
def scan_project(spark, sf_dir):
    rows = documents(spark, sf_dir)
    kept = rows.select("player_id", "college", "state", "seasons")
    return kept.withColumn("seasons", F.size("seasons"))


@R.query(
    "scan_exclude",
    "WITH" + _PEOPLE + " SELECT entity AS player_id, grp AS college, region AS state, number "
    "FROM people",
)
def scan_exclude(spark, sf_dir):
    return documents(spark, sf_dir).drop("seasons")


@R.query(
    "nested_get",
    "WITH"
    + SEASON_CTE
    + f""" SELECT c.entity AS player_id, {snap_sql("p98.points")} AS points_1998,
  {snap_sql("p99.steals")} AS steals_1999
FROM (SELECT DISTINCT entity FROM seasons) c
LEFT JOIN seasons p98 ON p98.entity = c.entity AND p98.period = 1998
LEFT JOIN seasons p99 ON p99.entity = c.entity AND p99.period = 1999""",
)
def nested_get(spark, sf_dir):
    return entries(spark, sf_dir).select(
        "player_id",
        snap(docs.entry_stat(F.lit(1998), "points")).alias("points_1998"),
        snap(docs.entry_stat(F.lit(1999), "steals")).alias("steals_1999"),
    )


@R.query(
    "scan_statistics",
    "WITH"
    + SEASON_CTE
    + ","
    + _PEOPLE
    + f""" SELECT entity AS player_id, region AS state, CAST(period AS INTEGER) AS period,
  {snap_sql("points")} AS points, {snap_sql("plus_minus")} AS plus_minus
FROM seasons JOIN people USING (entity)""",
)
def scan_statistics(spark, sf_dir):
    """Two of the 26 statistics of stored documents; the scan reads these and no games."""
    rows = docs.entry_rows(entries(spark, sf_dir), ["player_id", "state"], ["points", "plus_minus"])
    return rows.withColumns({s: snap(s) for s in ("points", "plus_minus")})


@R.query(
    "compact_documents",
    "WITH"
    + SEASON_CTE
    + ","
    + _PEOPLE
    + ", flat AS (SELECT entity, grp, region, CAST(period AS INTEGER) AS season, s.* FROM seasons "
    + "JOIN people USING (entity), LATERAL (VALUES "
    + ", ".join(f"('{s}', {snap_sql(s)})" for s in STATS)
    + ") AS s(stat, value)) SELECT entity AS player_id, grp AS college, region AS state, season, "
    "stat, value FROM flat",
)
def compact_documents(spark, sf_dir):
    rows = documents(spark, sf_dir)
    compacted = docs.compact(rows, ["player_id", "college", "state"], STATS)
    keys = ["player_id", "college", "state"]
    by_season = compacted.select(*keys, F.explode("seasons").alias("s"))
    maps = by_season.select(*keys, "s.season", F.explode("s.stats").alias("m"))
    entries = maps.select(*keys, "season", F.explode("m").alias("stat", "value"))
    return entries.withColumn("value", snap("value"))


@R.query(
    "debut_season_nested",
    "WITH"
    + SEASON_CTE
    + """, ordered AS (SELECT entity, period, min(period) OVER (PARTITION BY entity) AS debut,
  row_number() OVER (PARTITION BY entity ORDER BY period) AS rn FROM seasons)
SELECT entity AS player_id, CAST(debut AS INTEGER) AS debut, CAST(count(*) AS INTEGER) AS run
FROM ordered WHERE rn <= 4 AND period - debut = rn - 1 GROUP BY 1, 2""",
)
def debut_season_nested(spark, sf_dir):
    rows = documents(spark, sf_dir)
    return rows.select(
        "player_id",
        F.array_min(F.map_keys("seasons")).alias("debut"),
        F.size(run_of_map(F.col("seasons"))).alias("run"),
    )
