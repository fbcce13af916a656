"""Every registered query against its SQL on DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from routepulse.workload.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return f"{float(v):.6f}"
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(rows, df.columns) == normal(result.fetchall(), columns)


SORTED = {
    "driver_table": lambda r: (-r["peak_drop_pp"], r["driver_id"]),
    "worst_routes_25": lambda r: (-r["late_rate"], r["route_id"]),
}


@pytest.mark.parametrize("name", list(SORTED))
def test_sorted_views_come_sorted(spark, name):
    rows = contract.queries()[name](spark, FOLDER).collect()
    assert rows == sorted(rows, key=SORTED[name])
