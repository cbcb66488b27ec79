"""Every registered query against its SQL on the smallest tables."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from oracle.statements import STATEMENTS
from tallyhouse.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return f"D{value}" if isinstance(value, Decimal) else repr(value)


def content(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry_points.queries()) and set(STATEMENTS) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    result = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in result.collect()]
    assert len(set(result.columns)) == len(result.columns)
    wanted = db.sql(STATEMENTS[name])
    assert content(result.columns, rows) == content(wanted.columns, wanted.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 83


@pytest.mark.parametrize("name", ["q01_monthly_revenue", "q06_status_by_location", "q10_failed_analysis"])
def test_reports_scan_only_what_they_need(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "product_name" not in plan and "transaction_id" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
