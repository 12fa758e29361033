"""Every registered query against its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from orderloom.plans import catalogue
from orderloom.plans.queries_models import TABLES

FOLDERS = [f"/root/testdata/sf{scale}" for scale in ("0.001", "0.01")]


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def same_form(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)
    return [names[i] for i in order], body


def compare(spark, folder, name):
    df = contract.queries()[name](spark, folder)
    got = same_form(df.columns, [tuple(r) for r in df.collect()])
    with connect(folder) as con:
        result = con.execute(contract.oracle_sql()[name])
        expected = same_form([d[0] for d in result.description], result.fetchall())
    assert got == expected


# Queries over a fitted curve are the ones whose last digits depend on the data.
FITTED = sorted(name for name, sql in catalogue.ORACLES.items() if "fit(" in sql)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, name):
    compare(spark, FOLDERS[0], name)


@pytest.mark.parametrize("name", FITTED)
def test_fitted_query_equals_sql_on_more_rows(spark, name):
    compare(spark, FOLDERS[1], name)


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["user_id", "total_revenue", "pct_revenue"]
