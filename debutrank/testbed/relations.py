"""Scalar operators, joins, deduplication and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from debutrank.functions import cells, periods
from debutrank.operators import dedupe, joins, numbering, ranking, runs
from debutrank.operators.documents import game_means
from debutrank.testbed.registry import Registry, snap, snap_sql
from debutrank.testbed.seasons import MEMBERS_CTE, members, nations, table

R = Registry()


@R.query(
    "lenient_parse",
    """SELECT o_orderkey, coalesce(TRY_CAST(CASE o_orderstatus
  WHEN 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
  WHEN 'F' THEN o_orderpriority ELSE '' END AS DOUBLE), 0) AS value FROM orders""",
)
def lenient_parse(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    status = F.col("o_orderstatus")
    text = F.when(status == "O", price).when(status == "F", F.col("o_orderpriority")).otherwise("")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", cells.lenient_double(text).alias("value")
    )


@R.query(
    "season_label",
    """SELECT o_orderkey, y || '-' || (y + 1) AS label, CAST(y AS INTEGER) AS start,
  (y + 1) || '-' || (y + 2) AS next FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders)""",
)
def season_label(spark, sf_dir):
    labelled = table(spark, sf_dir, "orders").select(
        "o_orderkey", periods.season_label(F.year("o_orderdate")).alias("label")
    )
    return labelled.select(
        "o_orderkey",
        "label",
        periods.season_start(F.col("label")).alias("start"),
        periods.shift_label(F.col("label")).alias("next"),
    )


def _careers(spark, sf_dir):
    year = F.year("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("entity"))
        .agg(F.min(year).alias("debut"), F.max(year).alias("last"))
    )


_CAREERS = """careers AS (SELECT o_custkey AS entity, min(year(o_orderdate)) AS debut,
  max(year(o_orderdate)) AS last FROM orders GROUP BY 1)"""
_EXPANDED = """expanded AS (SELECT entity, CAST(unnest(range(debut,
  CASE WHEN last = debut THEN last + 2 ELSE last + 1 END)) AS INTEGER) AS period FROM careers)"""


@R.query("season_expand", f"WITH {_CAREERS}, {_EXPANDED} SELECT * FROM expanded")
def season_expand(spark, sf_dir):
    rows = runs.season_range(_careers(spark, sf_dir), "debut", "last")
    return rows.select("entity", "period")


@R.query(
    "season_expand_first4",
    f"WITH {_CAREERS} SELECT entity, CAST(unnest(range(debut, debut + 4)) AS INTEGER) AS period "
    "FROM careers",
)
def season_expand_first4(spark, sf_dir):
    rows = runs.season_range(_careers(spark, sf_dir), "debut", "last", first=4)
    return rows.select("entity", "period")


@R.query(
    "dimension_default",
    """SELECT entity, grp, CASE WHEN grp = 'null' THEN 'null' ELSE coalesce(r_name, 'no state') END
  AS region FROM (SELECT c_custkey AS entity,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 'null' ELSE n_name END AS grp
    FROM customer JOIN nation ON c_nationkey = n_nationkey)
LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'EUROPE') ON grp = n_name""",
)
def dimension_default(spark, sf_dir):
    people = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("entity"),
            F.when(F.col("c_mktsegment") != "FURNITURE", F.col("n_name")).alias("grp"),
        )
    )
    known = nations(spark, sf_dir).filter("r_name <> 'EUROPE'")
    groups = known.select(F.col("n_name").alias("grp"), F.col("r_name").alias("region"))
    return joins.with_region(people, groups, "grp", "region").select("entity", "grp", "region")


@R.query(
    "join_season_stats",
    f"""WITH {_CAREERS}, {_EXPANDED},
firsts AS (SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period,
  min_by(o_totalprice, o_orderkey) AS price, min_by(o_orderpriority, o_orderkey) AS priority
  FROM orders GROUP BY 1, 2)
SELECT entity, period, price, priority FROM expanded LEFT JOIN firsts USING (entity, period)""",
)
def join_season_stats(spark, sf_dir):
    stats = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity"),
        F.year("o_orderdate").alias("period"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderkey",
    )
    return joins.look_up(
        season_expand(spark, sf_dir),
        stats,
        ["entity", "period"],
        ["price", "priority"],
        order=["o_orderkey"],
    )


@R.query("join_player_dim", f"WITH {MEMBERS_CTE} SELECT entity, grp, region FROM members")
def join_player_dim(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("n_nationkey")
    )
    places = nations(spark, sf_dir).withColumnsRenamed({"n_name": "grp", "r_name": "region"})
    found = joins.look_up(people, places, ["n_nationkey"], ["grp", "region"], order=["grp"])
    return found.select("entity", "grp", "region")


@R.query(
    "join_display_name",
    "SELECT o_orderkey, o_custkey AS entity, c_name AS name FROM orders "
    "LEFT JOIN customer ON o_custkey = c_custkey",
)
def join_display_name(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_name").alias("name")
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("entity"))
    found = joins.look_up(rows, names, ["entity"], ["name"])
    return found.select("o_orderkey", "entity", "name")


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
_LINE_KEY = ["l_orderkey", "l_linenumber"]


def _deduped_sql(direction):
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) "
        "AS rn FROM lineitem) WHERE rn = 1"
    )


def _line_columns(rows):
    return rows.select(
        *_LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@R.query("dedupe_last", _deduped_sql("DESC"))
def dedupe_last(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _line_columns(dedupe.dedupe_last(lines, _LINE_KEY, _LINE_ORDER))


@R.query("dedupe_first", _deduped_sql("ASC"))
def dedupe_first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _line_columns(dedupe.dedupe_first(lines, _LINE_KEY, _LINE_ORDER))


@R.query(
    "dense_number",
    "SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey "
    "NULLS FIRST, o_orderkey NULLS FIRST) - 1 "
    "AS number FROM orders",
)
def dense_number(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return numbering.dense_number(orders, ["o_custkey", "o_orderkey"])


@R.query(
    "season_game_means",
    f"""SELECT entity, CAST(period AS INTEGER) AS period,
  {snap_sql("CAST(sum(price) AS DOUBLE) / games")} AS game_score,
  {snap_sql("CAST(sum(margin) AS DOUBLE) / games")} AS plus_minus
FROM (SELECT o_custkey AS entity, year(o_orderdate) AS period,
    CASE WHEN l_returnflag <> 'A' THEN CAST(l_extendedprice AS DECIMAL(18,4)) ELSE 0 END AS price,
    CAST(l_extendedprice AS DECIMAL(18,4)) - CAST(o_totalprice AS DECIMAL(18,4)) AS margin,
    count(DISTINCT (l_orderkey, l_linenumber))
      OVER (PARTITION BY o_custkey, year(o_orderdate)) AS games
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
GROUP BY entity, period, games""",
)
def season_game_means(spark, sf_dir):
    def exact(c):
        return F.col(c).cast("decimal(18,4)")

    games = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("entity"),
            F.year("o_orderdate").alias("period"),
            *_LINE_KEY,
            F.when(F.col("l_returnflag") != "A", exact("l_extendedprice")).alias("game_score"),
            (exact("l_extendedprice") - exact("o_totalprice")).alias("plus_minus"),
        )
    )
    means = game_means(games, ["entity", "period"], _LINE_KEY, ["game_score", "plus_minus"])
    return means.select(
        "entity",
        "period",
        snap("game_score").alias("game_score"),
        snap("plus_minus").alias("plus_minus"),
    )


@R.query(
    "sum_and_last",
    "SELECT c_mktsegment AS name, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS score, "
    "arg_max_null(c_nationkey, c_custkey) AS alumni FROM customer GROUP BY 1",
)
def sum_and_last(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("name"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("score"),
        F.col("c_nationkey").alias("alumni"),
        "c_custkey",
    )
    out = ranking.sum_and_last(rows, "name", "score", "alumni", ["c_custkey"])
    return out.withColumn("score", F.col("score").cast("double"))


@R.query(
    "debut_season",
    "SELECT o_custkey AS entity, CAST(min(year(o_orderdate)) AS INTEGER) AS debut "
    "FROM orders GROUP BY 1",
)
def debut_season(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period")
    )
    return runs.debut_period(rows, "entity", "period")


def _run_sql(source):
    return f"""WITH active AS ({source}),
ordered AS (SELECT entity, period, row_number() OVER (PARTITION BY entity ORDER BY period) AS rn,
  min(period) OVER (PARTITION BY entity) AS debut FROM active)
SELECT entity, CAST(period AS INTEGER) AS period, CAST(debut AS INTEGER) AS debut,
  CAST(rn AS INTEGER) AS run_position
FROM ordered WHERE rn <= 4 AND period - debut = rn - 1"""


@R.query(
    "first_run",
    _run_sql("SELECT DISTINCT o_custkey AS entity, year(o_orderdate) AS period FROM orders"),
)
def first_run(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period")
    )
    return runs.first_run(rows.distinct(), "entity", "period")


@R.query(
    "first_run_daily",
    _run_sql(
        "SELECT DISTINCT user_id AS entity, "
        "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS period FROM events"
    ),
)
def first_run_daily(spark, sf_dir):
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity"), day.alias("period")
    )
    return runs.first_run(rows.distinct(), "entity", "period")


@R.query(
    "replicate",
    "SELECT c_custkey || '#' || copy AS c_custkey, c_name, CAST(copy AS INTEGER) AS copy "
    "FROM customer, (SELECT unnest(range(3)) AS copy)",
)
def replicate(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.replicate(customers, 3, "c_custkey")


@R.query(
    "group_sum_count",
    f"""WITH {MEMBERS_CTE} SELECT coalesce(grp, 'null') AS grp,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS score, count(*) AS members
FROM members JOIN customer ON entity = c_custkey GROUP BY 1""",
)
def group_sum_count(spark, sf_dir):
    balances = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_acctbal").cast("decimal(18,2)").alias("score")
    )
    rows = ranking.with_group(balances, members(spark, sf_dir))
    out = ranking.group_sum_count(rows, "grp", "score")
    return out.withColumn("score", F.col("score").cast("double"))
