"""Every query runs on the smallest tables; those with SQL give the same rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

ALL = sorted(entry.queries())
SQL = entry.oracle_sql()


def shown(rows):
    return sorted(tuple("nan" if isinstance(v, float) and v != v else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", ALL)
def test_query(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if name in SQL:
        for t in os.listdir(sf):
            duckdb.sql(f"create or replace view {t.removesuffix('.parquet')} as select * from '{sf}/{t}'")
        r = duckdb.sql(SQL[name])
        assert sorted(r.columns) == columns
        assert shown(duckdb.sql(f"select {', '.join(columns)} from ({SQL[name]})").fetchall()) == shown(rows)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
