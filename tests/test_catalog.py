"""Every registered query beside its SQL, on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from lakeworks.catalog import ORACLE, QUERIES  # noqa: E402
from check_oracle import rows_of  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["month", "status", "orders", "revenue", "avg_order"]
