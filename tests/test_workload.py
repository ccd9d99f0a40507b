"""Every registered query against its SQL on the small tables."""

import datetime as dt
import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import TABLES

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_agrees_with_sql(spark, tables, name):
    frame = contract.queries()[name](spark, TABLES)
    rows = frame.collect()
    if name not in contract.oracle_sql():
        assert rows
        return
    cursor = tables.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _sorted(frame.columns, rows) == _sorted(columns, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
