"""Every query with SQL gives the same rows as DuckDB on the same tables; the rest give rows with a stable schema."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

CORE = {k: v for m in entry._MODULES for k, v in __import__(m, fromlist=["QUERIES"]).QUERIES.items()}
SQL = {k: v for m in entry._MODULES for k, v in __import__(m, fromlist=["SQL"]).SQL.items()}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(v):
        if isinstance(v, bool) or v is None:
            return v
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None).isoformat()[:19]
        if isinstance(v, datetime.date):
            return v.isoformat()
        try:
            return round(float(v), 6)
        except (TypeError, ValueError):
            return str(v)

    return sorted(repr([one(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, duck, name):
    df = CORE[name](spark, data)
    got = duck.execute(SQL[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(got.fetchall(), columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "score", "tier", "escalation"] and df.count() > 0


def test_keys_of_oracle_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
