"""Every query that has SQL gives the SQL's rows at the smallest size; every other one runs."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF

QUERIES, SQL = E.queries(), E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def plain(v):
    if v is None or isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return "nan" if math.isnan(v) else repr(round(float(v), 9) + 0.0)
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name in SQL:
        r = duck.execute(SQL[name])
        at = [d[0] for d in r.description]
        assert sorted(at) == columns
        assert got == sorted(tuple(plain(x[at.index(c)]) for c in columns) for x in r.fetchall())


def test_entry(spark):
    assert E.entry(spark).count() >= 0
