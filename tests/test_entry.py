"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from pricequarry.plans import catalogue, problems, roundtrips

NAMES = sorted({**catalogue.QUERIES, **problems.QUERIES, **roundtrips.QUERIES})


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(name, spark, sf, duck):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    q = duck.execute(sql)
    names = [d[0] for d in q.description]
    assert sorted(names) == columns
    assert Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in q.fetchall()) == got


def test_contract(spark, sf):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
