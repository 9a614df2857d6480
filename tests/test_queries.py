"""Every query runs at the smallest scale and agrees with its SQL."""

import datetime as dt
import decimal
import math
import os

import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(scope="module")
def duck(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.partition('.')[0]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    return con


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    got = ordered(df.select(*[f"`{c}`" for c in cols]).collect())
    if name in SQL:
        r = duck.execute(SQL[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == cols
        assert got == ordered([r_[names.index(c)] for c in cols] for r_ in r.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
