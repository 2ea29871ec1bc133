"""Driver contract: entry smoke run and every query against its DuckDB SQL."""

import datetime as dt

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from querytrail.plans.catalog import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(row):
    out = []
    for v in row:
        if isinstance(v, float):
            v = round(v, 6)
        if isinstance(v, dt.datetime):
            v = v.replace(tzinfo=None)
        out.append(v)
    return tuple(out)


def _sorted(rows):
    return sorted((_norm(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["start_time", "end_time", "search", "count"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    spark_rows = _sorted(tuple(r[c] for c in sorted(cols)) for r in df.collect())
    idx = [cols.index(c) for c in sorted(cols)]
    duck_rows = _sorted(tuple(r[i] for i in idx) for r in res.fetchall())
    assert len(spark_rows) == len(duck_rows)
    assert spark_rows == duck_rows
