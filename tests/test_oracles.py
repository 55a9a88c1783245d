from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "customer supplier orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, con, name):
    ours = entry.queries()[name](spark, SF)
    columns = sorted(ours.columns)
    got = sorted(map(repr, map(tuple, ours.select(*columns).collect())))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    assert got == sorted(map(repr, wanted))


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
