"""Time the headline queries and print one JSON line.

Every query starts from the raw tables: the season table and the profile are built
again for each of them, so a time is that of one whole application without start-up.
``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from pyspark.sql import functions as F

from debutrank.plans.rankings import rank_groups
from debutrank.session import local_session, release, use_folder
from debutrank.testbed import seasons as testbed
from debutrank.testbed.queries import QUERIES
from debutrank.testbed.seasons import forget

COPIES = 8  # of every customer, for the timings on a larger number of entities

HEADLINE = (
    "season_table",
    "profile_long",
    "player_score_att",
    "group_score_att",
    "group_score_plm",
    "all_categories_players",
    "all_categories_groups",
    "state_scores",
    "topk_per_category",
    "nest_documents",
    "dedupe_last",
    "first_run",
    "page_list_extract",
    "dense_number",
)


def run(spark, sf_dir: str, name: str) -> float:
    forget()
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def replicated_tables(spark, sf_dir: str, folder: str) -> str:
    """The test tables with every customer, order and order line replicated."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    keys = {
        "customer": ["c_custkey"],
        "orders": ["o_orderkey", "o_custkey"],
        "lineitem": ["l_orderkey"],
        "nation": [],
        "region": [],
    }
    for name, columns in keys.items():
        rows = testbed.table(spark, sf_dir, name)
        if columns:
            rows = rows.withColumn("_copy", copy)
            shifted = {c: F.col(c) * COPIES + F.col("_copy") for c in columns}
            rows = rows.withColumns(shifted).drop("_copy")
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


def run_replicated(spark, sf_dir: str, action: str) -> float:
    """Group ranking from replicated raw tables on: eight times the order lines as well."""
    forget()
    started = time.perf_counter()
    rows = testbed.seasons(spark, sf_dir)
    profile = testbed.season_profile(spark, sf_dir)
    ranked = rank_groups(rows, profile, testbed.members(spark, sf_dir), action)
    ranked.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "debutrank-bench")
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="debutrank-bench-")
    use_folder(spark, work)
    warm_up = run(spark, sf_dir, "group_score_att")
    times = {name: round(run(spark, sf_dir, name), 3) for name in HEADLINE}
    many = replicated_tables(spark, sf_dir, f"{work}/replicated")
    for action in ("attackers", "plus_minus"):
        name = f"group_score_{action}_x{COPIES}"
        times[name] = round(run_replicated(spark, many, action), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "warm_up": round(warm_up, 3),
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
