"""Every registered query equals its SQL oracle (DuckDB) on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from candlewick.plans.catalog import QUERIES
from candlewick.plans.duckdb_sql import SQL

D = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    from pyspark.sql.types import TimestampType
    df = QUERIES[name](spark, D)
    ltz = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    assert not ltz, f"session-zone dependent timestamp columns: {ltz}"
    cols = sorted(df.columns)
    got = _sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    cur = con.execute(SQL[name])
    dcols = [c[0] for c in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = _sorted([tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()])
    assert len(got) == len(exp)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
