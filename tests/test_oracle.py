"""Every query with an SQL form gives the same rows in DuckDB."""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        source = path if os.path.isfile(path) else f"{path}/*.parquet"
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{source}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = duck.sql(ORACLE[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    theirs = Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    assert ours == theirs


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_form_has_a_query():
    assert set(ORACLE) <= set(entry.queries())
