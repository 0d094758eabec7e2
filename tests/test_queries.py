"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
LAKE = sorted(entry.lake.ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, int)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return str(value)


@pytest.mark.parametrize("name", LAKE)
def test_same_rows(spark, duck, name):
    out = entry.queries()[name](spark, FOLDER)
    columns = sorted(out.columns)
    found = sorted((tuple(map(plain, r)) for r in out.select(*columns).collect()), key=str)
    rows = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rows.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert found == sorted((tuple(plain(r[i]) for i in at) for r in rows.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
