"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF
from corpusloom.plans.fixtures import TABLES
from tools.check_oracles import normal_rows

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = normal_rows(df.columns, df.collect())
    assert rows
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows == normal_rows(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
