"""Every registered query against its SQL on the smallest data folder."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")
SQL = entry.oracles.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name in entry._QUERIES}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, oracle, name):
    df = QUERIES[name](spark, str(FOLDER))
    names = sorted(df.columns)
    expected = oracle.sql(SQL[name])
    assert sorted(expected.columns) == names
    found = df.select(*names).collect()
    assert found
    assert sorted(map(str, map(tuple, found))) == sorted(
        map(str, expected.select(*names).fetchall())
    )


def test_derived_facts_are_the_resolved_deliveries(spark):
    cricket = entry._Cricket(spark, str(FOLDER))
    resolved = entry.ops.fact_delivery(cricket.deliveries(), cricket.registry())
    assert resolved.exceptAll(cricket.facts()).isEmpty()
    assert cricket.facts().exceptAll(resolved).isEmpty()


def test_flagship(spark):
    assert not entry.entry(spark).isEmpty()
