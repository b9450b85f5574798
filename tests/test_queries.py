"""Every registered query equals its DuckDB oracle on the driver tables (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from tributary.oracle import ORACLE_SQL
from tributary.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return round(v, 6)
        if hasattr(v, "isoformat"):
            return v.isoformat(sep=" ")
        return v
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, duck, key):
    df = E.queries()[key](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "o_orderkey" in df.columns
