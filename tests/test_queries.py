"""Every query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from workload import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value if isinstance(value, str) else int(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(found, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", list(queries.registry()))
def test_query_matches_its_sql(spark, duck, name):
    found = queries.registry()[name](spark, SF_DIR)
    stated = duck.sql(oracles.statements()[name])
    assert sorted(found.columns) == sorted(stated.columns)
    rows = rows_of(found.columns, found.collect())
    assert rows and rows == rows_of(stated.columns, stated.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
    assert set(queries.registry()) == set(oracles.statements()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
