"""What is kept up to date: merged batches and tables that are changed by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from debutrank.operators import bitmaps, profile_state
from debutrank.operators.profile import STORED_STATS_PER_PASS, profile_long
from debutrank.operators.ranking import group_sum_count
from debutrank.session import shared_path, written
from debutrank.sources import keyed, store
from debutrank.sources.tsv import read_checked
from debutrank.testbed.registry import Registry, snap
from debutrank.testbed.scans import R as SCANS
from debutrank.testbed.seasons import order_lines, seasons, table

R = Registry()

BATCHES = 3


@R.query("profile_merge", SCANS.sql["sink_profile"])
def profile_merge(spark, sf_dir):
    """The profile after three batches of entities, each merged into what is stored."""
    rows = seasons(spark, sf_dir)
    path = shared_path(spark, "profile-state")
    for i in range(BATCHES):
        batch = rows.filter(F.pmod("entity", F.lit(BATCHES)) == i)
        state = profile_state.state(batch, stats_per_pass=STORED_STATS_PER_PASS)
        store.add_to_profile(state, path) if i else store.start_profile(state, path)
    long = profile_long(store.kept_profile(spark, path))
    return long.select(
        "period", "stat", snap("mean").alias("mean"), snap("variance", 1e2).alias("variance"),
        snap("max").alias("max"), snap("min").alias("min"),
    )


_COUNTED = {
    "orders": bitmaps.Counted("l_orderkey"),
    "lines": bitmaps.Counted("l_linenumber", within="l_orderkey"),
    "suppliers": bitmaps.Counted("l_suppkey"),
}


@R.query(
    "distinct_merge",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS period, count(DISTINCT l_orderkey) AS orders, "
    "count(DISTINCT (l_orderkey, l_linenumber)) AS lines, count(DISTINCT l_suppkey) AS suppliers "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
)
def distinct_merge(spark, sf_dir):
    """Exact distinct counts per year, from words that were made of the two kinds of lines and stored."""
    lines = order_lines(spark, sf_dir).select("period", "l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus")
    open_lines = F.col("l_linestatus") == "O"
    halves = [
        written(bitmaps.words(lines.filter(half), ["period"], _COUNTED), "words") for half in (open_lines, ~open_lines)
    ]
    merged = bitmaps.merge_words(halves[0].unionByName(halves[1]), ["period"])
    return bitmaps.distinct_counts(merged, ["period"], list(_COUNTED))


@R.query(
    "keyed_update",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, CASE WHEN spent IS NULL THEN c_acctbal "
    "ELSE spent END AS balance FROM customer LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS "
    "DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 1) ON c_custkey = o_custkey",
)
def keyed_update(spark, sf_dir):
    """Customers in a table of buckets, their balances set by one update."""
    path = shared_path(spark, "customers")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), F.col("c_acctbal").alias("balance")
    )
    keyed.create(customers, path, ["c_custkey"], buckets=16)
    year = table(spark, sf_dir, "orders").filter(F.year("o_orderdate") == 1995)
    spent = group_sum_count(
        year.select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price")), "o_custkey", "price"
    ).select(F.col("o_custkey").alias("c_custkey"), F.col("price").cast("double").alias("new"))

    def set_balance(present):
        joined = present.join(spent, "c_custkey", "left")
        return joined.withColumn("balance", F.coalesce("new", "balance"))

    keyed.change(spark, path, spent, set_balance)
    return keyed.read(spark, path)


@R.query(
    "number_continued",
    "WITH first AS (SELECT DISTINCT o_custkey AS entity FROM orders WHERE year(o_orderdate) < 1995), "
    "old AS (SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS number FROM first), "
    "rest AS (SELECT DISTINCT o_custkey AS entity FROM orders WHERE o_custkey NOT IN (SELECT entity FROM first)) "
    "SELECT * FROM old UNION ALL SELECT entity, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY entity) - 1 "
    "FROM rest",
)
def number_continued(spark, sf_dir):
    """The customers of the years up to 1994 are numbered by one load, the others by a second one with all years."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), "o_orderdate")
    path = shared_path(spark, "numbers")
    store.number_stored(orders.filter(F.year("o_orderdate") < 1995), path, "entity")
    return store.number_stored(orders, path, "entity")


@R.query(
    "rejected_lines",
    "WITH cells AS (SELECT coalesce(CAST(o_orderkey AS VARCHAR), '') AS key, coalesce(o_orderstatus, '') AS status, "
    "o_orderpriority AS priority FROM orders) "
    "SELECT CASE WHEN priority = '1-URGENT' THEN key || chr(9) || status "
    "ELSE key || chr(9) || '\"' || status || chr(9) || priority END AS line FROM cells "
    "WHERE priority IN ('1-URGENT', '5-LOW')",
)
def rejected_lines(spark, sf_dir):
    """Orders as lines, some of them with a cell too few or with a quote that is not closed."""
    orders = table(spark, sf_dir, "orders").select(
        F.coalesce(F.col("o_orderkey").cast("string"), F.lit("")).alias("key"),
        F.coalesce("o_orderstatus", F.lit("")).alias("status"),
        F.coalesce("o_orderpriority", F.lit("")).alias("priority"),
    )
    line = (
        F.when(F.col("priority") == "1-URGENT", F.concat_ws("\t", "key", "status"))
        .when(F.col("priority") == "5-LOW", F.concat_ws("\t", "key", F.concat(F.lit('"'), "status"), "priority"))
        .otherwise(F.concat_ws("\t", "key", "status", "priority"))
    )
    path = shared_path(spark, "order-lines")
    orders.select(line.alias("line")).write.text(path)
    return read_checked(spark, path, ["key", "status", "priority"], header=False).rejected.select("line")
