"""Differential check: registered queries vs their DuckDB SQL at sf0.001."""

import hashlib

import pytest

import __spark_entry__ as E
from courtside.catalog import QUERIES

duckdb = pytest.importorskip("duckdb")

def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(repr(round(r[i], 9)) if isinstance(r[i], float) else repr(r[i]) for i in order)
                   for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con(sf_small):
    from courtside.sources.adapter import DRIVER_TABLES

    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())  # optional modules may have queries that SQL can't express


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 34
    assert df.count() >= 0
