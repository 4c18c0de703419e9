"""Every registered query against its SQL statement, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from debutrank.testbed import queries as testbed
from tools.check import TABLES, compare

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(testbed.QUERIES) == set(testbed.ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, sf_dir, name):
    message, _ = compare(spark, con, name, sf_dir, QUERIES[name], ORACLE[name])
    assert message.startswith("ok"), message
    assert "TYPES" not in message, message


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity", "score"]
    assert df.count() > 0
