"""Season table of the test tables: customers as entities, order years as periods.

An order line stands for a game with the key (order, line number), a nation for a
group and a region for a region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from debutrank.operators.bitmaps import Counted, distinct_counts, words
from debutrank.operators.profile import STORED_STATS_PER_PASS, profile
from debutrank.schemas import STATS
from debutrank.session import bucketed, written

_schemas: dict[str, StructType] = {}
_stored: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _exact(column: str, kind: str) -> Column:
    return F.col(column).cast(kind)


def _steps(column: str) -> Column:
    return F.rint(F.col(column) * 10_000).cast("long")


def _exact_lines(lines: DataFrame) -> DataFrame:
    """Lines with decimals: sums over them are exact and do not depend on the order of the rows.

    The small ones are narrow enough for sums that fit a long.
    """
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
        _exact("l_quantity", "decimal(8,4)").alias("quantity"),
        _exact("l_discount", "decimal(8,4)").alias("discount"),
        _exact("l_tax", "decimal(8,4)").alias("tax"),
        _exact("l_extendedprice", "decimal(18,4)").alias("price"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their customer and year."""
    orders = table(spark, sf_dir, "orders")
    lines = _exact_lines(table(spark, sf_dir, "lineitem"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("entity"),
        F.year("o_orderdate").alias("period"),
        *lines.columns,
        _exact("o_totalprice", "decimal(18,4)").alias("order_price"),
    )


# Sums over the lines of an order, then over the orders of a season, in steps of 1/10000: whole
# numbers add up exactly, in any order, and in generated code. The classes of lines do not overlap, so most
# are empty in an order and take little room in the shuffle; what is asked for is added up from them.
_F = "coalesce(l_linestatus = 'F', false)"
_STEPS = {
    "q_nf": f"CASE WHEN l_returnflag = 'N' AND {_F} THEN quantity END",
    "q_nx": f"CASE WHEN l_returnflag = 'N' AND NOT {_F} THEN quantity END",
    "q_of": f"CASE WHEN l_returnflag <> 'N' AND {_F} THEN quantity END",
    "q_ox": f"CASE WHEN l_returnflag <> 'N' AND NOT {_F} THEN quantity END",
    "q_uf": f"CASE WHEN l_returnflag IS NULL AND {_F} THEN quantity END",
    "q_ux": f"CASE WHEN l_returnflag IS NULL AND NOT {_F} THEN quantity END",
    "d": "discount",
    "t": "tax",
    "p": "price",
}
_COUNTS = {
    "c": "count(*)",
    "r_o": "count_if(l_returnflag = 'R' AND l_linestatus <> 'F')",
    "r_f": "count_if(l_returnflag = 'R' AND l_linestatus = 'F')",
    "r_u": "count_if(l_returnflag = 'R' AND l_linestatus IS NULL)",
    "big": "count_if(discount >= 800)",
    "a_f": "count_if(l_returnflag = 'A' AND l_linestatus = 'F')",
    "a_x": f"count_if(l_returnflag = 'A' AND NOT {_F})",
}
_TOTALS = {
    "q": ["q_nf", "q_nx", "q_of", "q_ox", "q_uf", "q_ux"],
    "q_f": ["q_nf", "q_of", "q_uf"],
    "q_n": ["q_nf", "q_nx"],
    "q_o": ["q_of", "q_ox"],
    "r": ["r_o", "r_f", "r_u"],
    "a": ["a_f", "a_x"],
}

# Numbers of lines up to 63 are the bits of a word of their order; those beyond, if any, are counted with the suppliers.
_NEAR_LINES = "bit_or(CASE WHEN l_linenumber BETWEEN 0 AND 63 THEN shiftleft(1L, int(l_linenumber)) END)"
_FAR_LINE = "CASE WHEN l_linenumber NOT BETWEEN 0 AND 63 THEN l_linenumber END AS far_line"
_DISTINCT = {"far_lines": Counted("far_line", within="l_orderkey"), "suppliers": Counted("l_suppkey")}

# Statistic -> (numerator, denominator, scale).
_STATS = {
    "games_played": ("n", "1", "1D"),
    "played_minutes": ("q", "c", "1D"),
    "field_goals": ("q_f", "n", "1D"),
    "field_goals_attempted": ("q", "n", "1D"),
    "field_goals_percentage": ("q_f", "q", "1D"),
    "three_field_goals": ("q_nf", "n", "1D"),
    "three_field_goals_attempted": ("q_n", "n", "1D"),
    "three_field_goals_percentage": ("q_nf", "q_n", "1D"),
    "two_field_goals": ("q_of", "n", "1D"),
    "two_field_goals_attempted": ("q_o", "n", "1D"),
    "two_field_goals_percentage": ("q_of", "q_o", "1D"),
    "effective_field_goals_percentage": ("q_f + 0.5D * q_nf", "q", "1D"),
    "free_throws": ("a_f", "n", "1D"),
    "free_throws_attempted": ("a", "n", "1D"),
    "free_throws_percentage": ("a_f", "a", "1D"),
    "offensive_rebounds": ("100D * d", "n", "1D"),
    "defensive_rebounds": ("100D * t", "n", "1D"),
    "total_rebounds": ("100D * (d + t)", "n", "1D"),
    "assists": ("coalesce(suppliers, 0)", "n", "1D"),
    "steals": ("r_o", "n", "1D"),
    "blocks": ("r_f", "n", "1D"),
    "turnovers": ("big", "n", "1D"),
    "personal_fouls": ("r", "n", "1D"),
    "points": ("p", "n", "1000D"),
    "game_score": ("p", "nl", "1000D"),
    "plus_minus": ("pm", "nl", "1000D"),
}


def _ratio(numerator: str, denominator: str, scale: str) -> str:
    ratio = f"try_divide(cast({numerator} as double), cast({denominator} as double))"
    return f"coalesce({ratio}, 0D) / {scale}"


def build_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """26 statistics per customer and year.

    The lines are summed per order before they meet the orders, so the wide columns are joined
    once per order, and an order of very many lines is summed on the map side. Distinct lines and
    suppliers come from a second read of three columns, as bitmaps: in one aggregation with the sums,
    every line would be shuffled with all of their buffers.
    """
    keys = ["entity", "period"]
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("entity"),
        F.year("o_orderdate").alias("period"),
        _steps("o_totalprice").alias("order_price"),
    )
    lines = table(spark, sf_dir, "lineitem")
    same = F.col("l_orderkey") == F.col("o_orderkey")
    stepped = lines.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", _steps("l_quantity").alias("quantity"),
        _steps("l_discount").alias("discount"), _steps("l_tax").alias("tax"), _steps("l_extendedprice").alias("price"),
    )
    per_order = stepped.groupBy("l_orderkey").agg(
        *[F.expr(f"sum({e}) AS {n}") for n, e in _STEPS.items()],
        *[F.expr(f"{e} AS {n}") for n, e in _COUNTS.items()],
        F.expr(f"bit_count({_NEAR_LINES}) AS near_lines"),
    )
    sums = per_order.join(orders, same).groupBy(*keys).agg(
        *[F.expr(f"coalesce(sum({n}), 0L) AS {n}") for n in _STEPS],
        F.expr("coalesce(sum(4L * p - order_price * c), 0L) / 40000D AS pm"),
        *[F.sum(n).alias(n) for n in _COUNTS],
        F.sum(F.coalesce("near_lines", F.lit(0))).alias("near_lines"),
        F.count("*").alias("n"),
    )
    sums = sums.withColumns({n: F.expr(" + ".join(classes)) for n, classes in _TOTALS.items()})
    steps = [*_STEPS, *(n for n in _TOTALS if n.startswith("q"))]
    sums = sums.withColumns({n: F.expr(f"{n} / 10000D") for n in steps})
    narrow = lines.selectExpr("l_orderkey", "l_suppkey", _FAR_LINE).join(orders.drop("order_price"), same)
    numbers = distinct_counts(words(narrow, keys, _DISTINCT), keys, list(_DISTINCT))
    parts = sums.join(numbers, keys, "left").withColumn("nl", F.expr("near_lines + coalesce(far_lines, 0)"))
    return parts.selectExpr(*keys, *[f"round({_ratio(*_STATS[s])}, 9) AS {s}" for s in STATS])


def forget() -> None:
    """Make the next query build its tables again (used by the bench)."""
    _stored.clear()


def _once(spark: SparkSession, sf_dir: str, name: str, build, by: str | None = None) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = (
            bucketed(build(), name, [by], compression="zstd") if by else written(build(), name, compression="zstd")
        )
    return _stored[key]


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The season table, written once per session in buckets of the entity: the profile and the scores read it."""
    return _once(spark, sf_dir, "seasons", lambda: build_seasons(spark, sf_dir), by="entity")


def season_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the seasons, written once per session."""
    return _once(spark, sf_dir, "profile", lambda: stored_profile(seasons(spark, sf_dir)))


def stored_profile(seasons: DataFrame) -> DataFrame:
    return profile(seasons, stats_per_pass=STORED_STATS_PER_PASS)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their name, nation (group) and region, in the buckets of the seasons."""
    return _once(spark, sf_dir, "members", lambda: build_members(spark, sf_dir), by="entity")


def build_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("entity"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("grp"),
            F.col("r_name").alias("region"),
        )
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )


# The same season table in SQL. Every statement that uses it starts with these WITH
# clauses: lines, seasons, and the profile in the long form it needs.
SEASON_CTE = """
lines AS (
  SELECT o_custkey AS entity, year(o_orderdate) AS period, l_orderkey, l_linenumber, l_suppkey,
         l_returnflag AS rf, l_linestatus AS ls,
         CAST(l_quantity AS DECIMAL(18,4)) AS q, CAST(l_discount AS DECIMAL(18,4)) AS d,
         CAST(l_tax AS DECIMAL(18,4)) AS t, CAST(l_extendedprice AS DECIMAL(18,4)) AS p,
         CAST(o_totalprice AS DECIMAL(18,4)) AS tp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
sums AS (
  SELECT entity, period,
         count(*) AS c, count(DISTINCT l_orderkey) AS n,
         count(DISTINCT (l_orderkey, l_linenumber)) AS nl, count(DISTINCT l_suppkey) AS suppliers,
         CAST(sum(q) AS DOUBLE) AS q,
         CAST(coalesce(sum(q) FILTER (ls = 'F'), 0) AS DOUBLE) AS q_f,
         CAST(coalesce(sum(q) FILTER (rf = 'N'), 0) AS DOUBLE) AS q_n,
         CAST(coalesce(sum(q) FILTER (rf = 'N' AND ls = 'F'), 0) AS DOUBLE) AS q_nf,
         CAST(coalesce(sum(q) FILTER (rf <> 'N'), 0) AS DOUBLE) AS q_o,
         CAST(coalesce(sum(q) FILTER (rf <> 'N' AND ls = 'F'), 0) AS DOUBLE) AS q_of,
         CAST(sum(d) AS DOUBLE) AS d, CAST(sum(t) AS DOUBLE) AS t, CAST(sum(p) AS DOUBLE) AS p,
         CAST(sum(p - CAST(0.25 AS DECIMAL(3,2)) * tp) AS DOUBLE) AS pm,
         count(*) FILTER (rf = 'R' AND ls <> 'F') AS r_o,
         count(*) FILTER (rf = 'R' AND ls = 'F') AS r_f,
         count(*) FILTER (rf = 'R') AS r,
         count(*) FILTER (d >= 0.08) AS big,
         count(*) FILTER (rf = 'A' AND ls = 'F') AS a_f,
         count(*) FILTER (rf = 'A') AS a
  FROM lines GROUP BY entity, period
),
seasons AS (
  SELECT entity, period,
         CAST(n AS DOUBLE) AS games_played,
         round(q / c, 9) AS played_minutes,
         round(q_f / n, 9) AS field_goals,
         round(q / n, 9) AS field_goals_attempted,
         round(coalesce(q_f / nullif(q, 0), 0), 9) AS field_goals_percentage,
         round(q_nf / n, 9) AS three_field_goals,
         round(q_n / n, 9) AS three_field_goals_attempted,
         round(coalesce(q_nf / nullif(q_n, 0), 0), 9) AS three_field_goals_percentage,
         round(q_of / n, 9) AS two_field_goals,
         round(q_o / n, 9) AS two_field_goals_attempted,
         round(coalesce(q_of / nullif(q_o, 0), 0), 9) AS two_field_goals_percentage,
         round(coalesce((q_f + CAST(0.5 AS DOUBLE) * q_nf) / nullif(q, 0), 0), 9)
           AS effective_field_goals_percentage,
         round(CAST(a_f AS DOUBLE) / n, 9) AS free_throws,
         round(CAST(a AS DOUBLE) / n, 9) AS free_throws_attempted,
         round(coalesce(CAST(a_f AS DOUBLE) / nullif(a, 0), 0), 9) AS free_throws_percentage,
         round(CAST(100 AS DOUBLE) * d / n, 9) AS offensive_rebounds,
         round(CAST(100 AS DOUBLE) * t / n, 9) AS defensive_rebounds,
         round(CAST(100 AS DOUBLE) * (d + t) / n, 9) AS total_rebounds,
         round(CAST(suppliers AS DOUBLE) / n, 9) AS assists,
         round(CAST(r_o AS DOUBLE) / n, 9) AS steals,
         round(CAST(r_f AS DOUBLE) / n, 9) AS blocks,
         round(CAST(big AS DOUBLE) / n, 9) AS turnovers,
         round(CAST(r AS DOUBLE) / n, 9) AS personal_fouls,
         round(p / n / CAST(1000 AS DOUBLE), 9) AS points,
         round(p / nl / CAST(1000 AS DOUBLE), 9) AS game_score,
         round(pm / nl / CAST(1000 AS DOUBLE), 9) AS plus_minus
  FROM sums
)"""

MEMBERS_CTE = """
members AS (
  SELECT c_custkey AS entity, c_name AS name, n_name AS grp, r_name AS region
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""


def profile_cte(measures) -> str:
    """The needed measures (``<stat>_<op>``) in SQL, one row per period."""
    ops = {
        "mean": "round(avg({s}), 9)",
        "variance": "round(coalesce(var_samp({s}), 0), 9)",
        "max": "max({s})",
        "min": "min({s})",
    }
    columns = []
    for m in measures:
        stat, op = m.rsplit("_", 1)
        columns.append(f"{ops[op].format(s=stat)} AS {m}")
    return (
        "\nprofile AS (\n  SELECT period, "
        + ",\n         ".join(columns)
        + "\n  FROM seasons GROUP BY period\n)"
    )
