"""Every registered query of the core against its SQL on the plain tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from breachline.plans.table_queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in ("pages", "events", "documents"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


def test_every_query_is_registered_and_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE_SQL.items() <= contract.oracle_sql().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    expected = duck.sql(contract.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    rows = [tuple(row[c] for c in columns) for row in result.collect()]
    wanted = [tuple(r) for r in expected.project(", ".join(columns)).fetchall()]
    assert rows
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
