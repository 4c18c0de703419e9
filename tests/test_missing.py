"""Every query on tables with missing customers, unmatched nations, and negative or missing keys."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from debutrank.testbed import seasons as testbed
from debutrank.testbed.queries import ORACLE
from tools.check import TABLES, compare


@pytest.fixture(scope="module")
def gaps(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("gaps"))
    tables = {t: testbed.table(spark, sf_dir, t) for t in TABLES}

    def turned(df, key):  # every seventh key negative
        return df.withColumn(key, F.when(F.col(key) % 7 == 0, -F.col(key)).otherwise(F.col(key)))

    tables["lineitem"] = turned(tables["lineitem"], "l_orderkey")
    orders = turned(tables["orders"], "o_orderkey")
    lost = orders.limit(5).withColumn("o_orderkey", F.lit(None).cast(orders.schema["o_orderkey"].dataType))
    tables["orders"] = orders.union(lost)
    people = tables["customer"].filter("c_custkey % 3 <> 1")
    nation = F.when(F.col("c_custkey") % 5 == 0, 99).when(F.col("c_custkey") % 11 == 0, None)
    kind = people.schema["c_nationkey"].dataType
    tables["customer"] = people.withColumn("c_nationkey", nation.otherwise(F.col("c_nationkey")).cast(kind))
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    return folder, con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_tables_with_gaps(spark, gaps, name):
    folder, con = gaps
    message, _ = compare(spark, con, name, folder, entry.queries()[name], ORACLE[name])
    assert message.startswith("ok"), message


def test_drilldown_has_every_ranked_entity(spark, gaps):
    folder, _ = gaps
    queries = entry.queries()
    shown = queries["drilldown"](spark, folder).select("entity").distinct().count()
    assert shown == queries["player_score_att"](spark, folder).count()
