"""Every registered query against its SQL counterpart, on whole tables."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
import oracle
from punctual import registry

QUERIES, ORACLE = registry.queries(), oracle.queries()
NO_SQL = {"layout_report"}  # file sizes are not in SQL
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def kind(value):
    return "int" if isinstance(value, int) and not isinstance(value, bool) else type(value).__name__


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple((kind(row[i]), row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is None, str(value)) for _, value in row),
    )


def test_the_contract_names_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert ORACLE.items() <= contract.oracle_sql().items()


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    if name in NO_SQL:
        assert rows
        return
    expected = duck.sql(ORACLE[name])
    types = {name: TYPES[kind] for name, kind in df.dtypes}
    assert types == {
        name: str(kind) for name, kind in zip(expected.columns, expected.types, strict=True)
    }
    assert normal(rows, df.columns) == normal(expected.fetchall(), expected.columns)


def test_entry(spark):
    row = contract.entry(spark).first()
    assert row.delivered_orders == 476
    assert row.first_order_date >= datetime.date(1994, 1, 1)
    assert math.isclose(row.on_time_rate, 0.794118, abs_tol=1e-6)
    assert math.isclose(row.avg_delivery_days, 15.6071, abs_tol=1e-4)
    assert math.isclose(row.avg_slack_days, 7.5378, abs_tol=1e-4)
