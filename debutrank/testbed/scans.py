"""Sources, batches and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutrank.functions import cells
from debutrank.operators.joins import (
    insert_if_absent,
    limit_entities,
    update_if_present,
)
from debutrank.operators.profile import profile_long
from debutrank.operators.ranking import group_sum_count, with_group
from debutrank.schemas import STATS
from debutrank.session import shared_path
from debutrank.sources import batches, keyed, markup, pages, store
from debutrank.sources.tsv import read_scores, read_tsv, tab_lines, write_tsv
from debutrank.testbed.registry import Registry, snap, snap_sql
from debutrank.testbed.seasons import (
    MEMBERS_CTE,
    SEASON_CTE,
    members,
    nations,
    profile_cte,
    season_profile,
    table,
)

R = Registry()


@R.query(
    "scan_tsv",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, "
    "c_mktsegment FROM customer",
)
def scan_tsv(spark, sf_dir):
    path = shared_path(spark, "customer-tsv")
    customers = table(spark, sf_dir, "customer")
    write_tsv(customers, path)
    rows = read_tsv(spark, path, customers.columns)
    return rows.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


@R.query("scan_tsv_noheader", "SELECT s_name AS name, s_acctbal AS score FROM supplier")
def scan_tsv_noheader(spark, sf_dir):
    path = shared_path(spark, "scores-tsv")
    write_tsv(table(spark, sf_dir, "supplier").select("s_name", "s_acctbal"), path, header=False)
    schema = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return read_scores(spark, path, schema)


@R.query(
    "sink_tsv",
    "SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand, "
    "CAST(p_size AS VARCHAR) AS size FROM part",
)
def sink_tsv(spark, sf_dir):
    path = shared_path(spark, "parts-tsv")
    header = {"ID": "p_partkey", "NAME": "p_name", "BRAND": "p_brand", "SIZE": "p_size"}
    write_tsv(table(spark, sf_dir, "part"), path, header=header)
    rows = read_tsv(spark, path, ["part_id", "part_name", "brand", "size"])
    return rows.withColumn("part_id", F.col("part_id").cast("bigint"))


@R.query(
    "scan_range_batches",
    "SELECT CAST(floor(o_orderkey / 1000) AS BIGINT) AS batch, count(*) AS orders, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1",
)
def scan_range_batches(spark, sf_dir):
    rows = batches.with_range_batch(table(spark, sf_dir, "orders"), "o_orderkey", 1000)
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return rows.groupBy("batch").agg(F.count("*").alias("orders"), total.alias("total"))


@R.query(
    "scan_range_stored",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders, (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high "
    "FROM orders) WHERE o_orderkey >= low + (high - low) // 3 AND o_orderkey < low + (high - low) // 2",
)
def scan_range_stored(spark, sf_dir):
    """The orders of a stretch of numbers, from a table that is stored by ranges."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    path = shared_path(spark, "orders-by-range")
    batches.write_ranges(orders, path, "o_orderkey", (high - low) // 16 + 1)
    return batches.read_ranges(spark, path, "o_orderkey", low + (high - low) // 3, low + (high - low) // 2)


@R.query(
    "scan_prefix_partitions",
    "SELECT CASE WHEN lower(substr(p_name, 1, 1)) BETWEEN 'a' AND 'z' "
    "THEN lower(substr(p_name, 1, 1)) ELSE 'other' END AS prefix, count(*) AS parts, "
    "count(DISTINCT p_name) AS names FROM part GROUP BY 1",
)
def scan_prefix_partitions(spark, sf_dir):
    path = shared_path(spark, "parts-by-prefix")
    batches.write_prefixes(table(spark, sf_dir, "part").select("p_name"), path, "p_name")
    return batches.read_prefixes(spark, path).groupBy("prefix").agg(
        F.count("*").alias("parts"), F.count_distinct("p_name").alias("names")
    )


@R.query(
    "scan_prefix_stored",
    "SELECT p_partkey, p_name, lower(substr(p_name, 1, 1)) AS prefix FROM part "
    "WHERE lower(substr(p_name, 1, 1)) IN ('a', 'b', 'g', 's')",
)
def scan_prefix_stored(spark, sf_dir):
    """The parts of some first letters, from a table that is stored by first letter."""
    path = shared_path(spark, "parts-by-prefix")
    batches.write_prefixes(table(spark, sf_dir, "part").select("p_partkey", "p_name"), path, "p_name")
    return batches.read_prefixes(spark, path, ["a", "b", "g", "s"])


@R.query(
    "scan_prefix_keys",
    "SELECT p_partkey, p_name, CASE WHEN lower(substr(p_name, 1, 1)) BETWEEN 'a' AND 'z' "
    "THEN lower(substr(p_name, 1, 1)) ELSE 'other' END AS prefix FROM part "
    "WHERE p_name IN (SELECT p_name FROM part WHERE p_size = 1)",
)
def scan_prefix_keys(spark, sf_dir):
    """All parts of the names that another table asks for, from a table that is stored by first letter."""
    part = table(spark, sf_dir, "part")
    path = shared_path(spark, "parts-by-prefix")
    batches.write_prefixes(part.select("p_partkey", "p_name"), path, "p_name")
    wanted = part.filter("p_size = 1")
    return batches.read_keys(spark, path, wanted, "p_name").select("p_partkey", "p_name", "prefix")


@R.query(
    "scan_fixed_batches",
    "SELECT CAST(floor(n / 400) AS BIGINT) AS batch, count(*) AS customers, "
    "min(c_custkey) AS first_key, max(c_custkey) AS last_key FROM "
    "(SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS n FROM customer) "
    "GROUP BY 1",
)
def scan_fixed_batches(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    rows = batches.with_fixed_batch(customers, "c_custkey", 400)
    return rows.groupBy("batch").agg(
        F.count("*").alias("customers"),
        F.min("c_custkey").alias("first_key"),
        F.max("c_custkey").alias("last_key"),
    )


@R.query(
    "union_batches",
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CASE WHEN o_orderkey IS NULL THEN 3 ELSE "
    "(o_orderkey - low) // width END AS INTEGER) AS batch FROM orders, (SELECT low, "
    "CAST(ceil((high - low + 1) / 3) AS BIGINT) AS width "
    "FROM (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders))",
)
def union_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return batches.with_equal_batch(orders, "o_orderkey", 3)


@R.query(
    "limit_entities",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN "
    "(SELECT DISTINCT o_custkey FROM orders ORDER BY 1 LIMIT 100)",
)
def limit_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return limit_entities(orders, "o_custkey", 100)


# --- pages ---------------------------------------------------------------------

_NAV = {
    "target": r'<li><a href="([^"]*)">[^<]*</a></li>',
    "label": r'<li><a href="[^"]*">([^<]*)</a></li>',
}


@R.query(
    "page_list_extract",
    f"""WITH lists AS (
  SELECT page_id, regexp_extract_all(html, '{_NAV["target"]}', 1) AS targets,
         regexp_extract_all(html, '{_NAV["label"]}', 1) AS labels
  FROM pages),
spots AS (SELECT *, unnest(range(len(labels))) AS i FROM lists)
SELECT page_id, CAST(i AS INTEGER) AS position,
       coalesce(nullif(targets[i + 1], ''), 'null') AS target,
       coalesce(nullif(labels[i + 1], ''), 'null') AS label FROM spots""",
)
def page_list_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.list_entries(rows, "html", _NAV, lead="label")


_FIELDS = {
    "title": r"<title>([^<]*)</title>",
    "lang": r'<html lang="([^"]*)"',
    "heading": r"<h1>([^<]*)</h1>",
    "link": r'<a href="([^"]*)"',
    "ad": r'<!-- ad <key> --><div class="ad">([^<]*)',
}


def _second_else_first_sql(name, pattern):
    found = f"regexp_extract_all(html, '{pattern}', 1)"
    return f"coalesce({found}[2], {found}[1]) AS {name}"


# The engine that checks the statements wants constant patterns: the keyed cell is
# found by its marker instead, cutting the text between the marker and the next tag.
_AD_SQL = (
    "CASE WHEN contains(html, '<!-- ad ' || page_id || ' --><div class=\"ad\">') THEN "
    "split_part(split_part(html, '<!-- ad ' || page_id || ' --><div class=\"ad\">', 2), '<', 1) "
    "END AS ad"
)


@R.query(
    "page_field_extract",
    "SELECT page_id, "
    + ", ".join(_second_else_first_sql(n, p) for n, p in _FIELDS.items() if n != "ad")
    + f", {_AD_SQL} FROM pages",
)
def page_field_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.field_values(rows, "html", _FIELDS, key="page_id")


_ROW = r"(?s)(<ul>.*?</ul>)"
_CELL = r"(?s)<li>.*?</li>"


@R.query(
    "page_row_extract",
    f"""WITH found AS (SELECT page_id, regexp_extract_all(html, '{_ROW}', 1) AS rows FROM pages),
spots AS (SELECT page_id, rows, unnest(range(len(rows))) AS i FROM found),
cells AS (
  SELECT page_id, i, list_transform(regexp_extract_all(rows[i + 1], '{_CELL}'), lambda x:
    coalesce(nullif(regexp_extract(x, '^<[^<>]*>([^<]*)', 1), ''),
             nullif(regexp_extract(x, '^<[^<>]*>[^<]*<[a-zA-Z][^<>]*>([^<]*)', 1), ''), '0')) AS c
  FROM spots)
SELECT page_id, CAST(i AS INTEGER) AS position,
       array_to_string(CASE WHEN len(c) = 6 THEN c ELSE list_append(c, '0') END, '|') AS line,
       CAST(len(CASE WHEN len(c) = 6 THEN c ELSE list_append(c, '0') END) AS INTEGER) AS width
FROM cells""",
)
def page_row_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "html")
    found = pages.row_cells(rows, "html", _ROW, _CELL, width=6)
    return found.select(
        "page_id",
        "position",
        F.array_join("cells", "|").alias("line"),
        F.size("cells").alias("width"),
    )


@R.query(
    "pages_not_processed",
    "SELECT page_id, url FROM pages WHERE url <> '' AND page_id NOT IN "
    "(SELECT page_id FROM pages WHERE contains(html, '<html lang=\"en\"'))",
)
def pages_not_processed(spark, sf_dir):
    all_pages = table(spark, sf_dir, "pages")
    stored = all_pages.filter(F.contains("html", F.lit('<html lang="en"'))).select("page_id")
    return pages.not_processed(all_pages.select("page_id", "url"), stored, "page_id", "url")


# --- sinks ---------------------------------------------------------------------


@R.query(
    "sink_profile",
    "WITH"
    + SEASON_CTE
    + ","
    + profile_cte([f"{s}_{op}" for s in STATS for op in ("mean", "variance", "max", "min")])
    + " "
    + " UNION ALL ".join(
        f"""SELECT CAST(period AS INTEGER) AS period, '{s}' AS stat,
 {snap_sql(f"{s}_mean")} AS mean, {snap_sql(f"{s}_variance", "1e2")} AS variance,
 {snap_sql(f"{s}_max")} AS max, {snap_sql(f"{s}_min")} AS min FROM profile"""
        for s in STATS
    ),
)
def sink_profile(spark, sf_dir):
    path = shared_path(spark, "profile")
    store.write_profile(season_profile(spark, sf_dir), path)
    rows = profile_long(store.read_profile(spark, path))
    return rows.select(
        "period",
        "stat",
        snap("mean").alias("mean"),
        snap("variance", 1e2).alias("variance"),
        snap("max").alias("max"),
        snap("min").alias("min"),
    )


_SUPPLIER_SCORES = (
    "SELECT n_name AS name, max_by(s_acctbal, s_suppkey) AS score FROM supplier "
    "JOIN nation ON s_nationkey = n_nationkey GROUP BY 1"
)


@R.query(
    "merge_upsert",
    f"""WITH existing AS (SELECT n_name AS name, r_name AS state, CAST(0 AS DOUBLE) AS score
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')),
fresh AS (SELECT n_name AS name, min_by(c_mktsegment, c_custkey) AS state,
  min_by(c_acctbal, c_custkey) AS score
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE n_name NOT IN (SELECT name FROM existing) GROUP BY 1),
base AS (SELECT * FROM existing UNION ALL SELECT * FROM fresh),
updates AS ({_SUPPLIER_SCORES})
SELECT base.name, base.state, coalesce(updates.score, base.score) AS score
FROM base LEFT JOIN updates USING (name)""",
)
def merge_upsert(spark, sf_dir):
    existing, new, updates = _upsert_inputs(spark, sf_dir)
    path = shared_path(spark, "regions")
    keyed.create(existing, path, ["name"], buckets=8)
    store.save_upsert(path, new, updates, "name", "score", ["c_custkey"], ["s_suppkey"])
    return keyed.read(spark, path)


def _upsert_inputs(spark, sf_dir):
    places = nations(spark, sf_dir)
    existing = places.filter(F.col("r_name").isin("ASIA", "EUROPE")).select(
        F.col("n_name").alias("name"), F.col("r_name").alias("state"), F.lit(0.0).alias("score")
    )
    nation = table(spark, sf_dir, "nation")
    new = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("name"),
            F.col("c_mktsegment").alias("state"),
            F.col("c_acctbal").alias("score"),
            "c_custkey",
        )
    )
    updates = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("name"), F.col("s_acctbal").alias("score"), "s_suppkey")
    )
    return existing, new, updates


@R.query(
    "insert_if_absent",
    """WITH existing AS (SELECT n_name AS name, r_name AS state, CAST(0 AS DOUBLE) AS score
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))
SELECT * FROM existing UNION ALL
SELECT n_name, min_by(c_mktsegment, c_custkey), min_by(c_acctbal, c_custkey)
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name NOT IN (SELECT name FROM existing) GROUP BY 1""",
)
def insert_absent(spark, sf_dir):
    existing, new, _ = _upsert_inputs(spark, sf_dir)
    return insert_if_absent(existing, new, "name", ["c_custkey"])


@R.query(
    "update_if_present",
    f"""WITH existing AS (SELECT n_name AS name, r_name AS state, CAST(0 AS DOUBLE) AS score
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')),
updates AS ({_SUPPLIER_SCORES})
SELECT existing.name, state, coalesce(updates.score, existing.score) AS score
FROM existing LEFT JOIN updates USING (name)""",
)
def update_present(spark, sf_dir):
    existing, _, updates = _upsert_inputs(spark, sf_dir)
    return update_if_present(existing, updates, "name", "score", ["s_suppkey"])


@R.query(
    "flatten_tsv",
    "WITH"
    + MEMBERS_CTE
    + """ SELECT coalesce(grp, 'null') || chr(9) || CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS VARCHAR)
 || chr(9) || CAST(count(*) AS VARCHAR) AS line
FROM members JOIN customer ON entity = c_custkey GROUP BY coalesce(grp, 'null')""",
)
def flatten_tsv(spark, sf_dir):
    balances = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_acctbal").cast("decimal(18,2)").alias("score")
    )
    grouped = group_sum_count(with_group(balances, members(spark, sf_dir)), "grp", "score")
    nested = grouped.select("grp", F.struct("score", "members").alias("value"))
    return tab_lines(nested)


@R.query(
    "default_missing",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '0' ELSE o_orderstatus END AS status, "
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '0' ELSE o_orderpriority END AS priority "
    "FROM orders",
)
def default_missing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    gaps = orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "")
        .otherwise(F.col("o_orderpriority"))
        .alias("priority"),
    )
    return cells.default_missing(gaps, ["status", "priority"])


# A table with a table, a comment and a script in its cells, around the title of every page. A
# regular expression for rows and cells would end both with the inner table.
_NESTED = (
    "concat('<table class=\"t\"><tr id=''head''><th>no</th></tr><tr data-x=\"a>b\" id=''row.', page_id, '''><td>', "
    "page_id, '</td><td><!-- <td>old</td> --><b>', title, '</b></td><td><table><tr id=\"inner\"><td>in</td>"
    "<td>ner</td></tr></table></td><td><script>\"</td>\"</script>&#38;&#x41;</td></tr></table>')"
)


@R.query(
    "page_nested_rows",
    "WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages), "
    "d AS (SELECT page_id, coalesce(nullif(replace(replace(replace(replace(title, '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&amp;', '&'), ''), '0') AS title FROM t) "
    "SELECT page_id, 0 AS position, page_id || '|' || title || '|0|&A|0' AS line FROM d "
    "UNION ALL SELECT page_id, 1, 'in|ner|0' FROM d",
)
def page_nested_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title")
    )
    nested = rows.select("page_id", F.expr(_NESTED).alias("html"))
    found = markup.row_cells(nested, "html", r"^(row\.\d+|inner)$", width=5)
    return found.select("page_id", "position", F.array_join("cells", "|").alias("line"))
