"""Each query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from arbora.plans.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return str(x)
    try:
        return "None" if x != x else str(round(float(x), 6))
    except (TypeError, ValueError):
        return str(x)


def told(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(plain(None if v is None else v) for v in row) for row in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert told(QUERIES[name](spark, DIR).toPandas()) == told(duck.sql(SQL[name]).df())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
