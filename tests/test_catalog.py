"""Every bound query against its SQL on the given tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert {r["column"] for r in rows} == {"l_returnflag", "l_linestatus"}


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    got = driver.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    ours = sorted(tuple(shown(r[c]) for c in columns) for r in got.collect())
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert ours
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(shown(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert ours == theirs
