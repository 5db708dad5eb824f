"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import collections

import duckdb
import pytest

from __spark_entry__ import entry
from loadsmith.registry import oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return 0.0 if isinstance(v, float) and v == 0.0 else v


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rel = con.execute(oracle_sql()[name])
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    order = sorted(d_cols)
    s_rows = df.collect()
    s = collections.Counter(tuple(_norm(r[c]) for c in order) for r in s_rows)
    d = collections.Counter(tuple(_norm(r[d_cols.index(c)]) for c in order) for r in d_rows)
    assert len(s_rows) == len(d_rows)
    assert s == d


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[-2:] == ["DEPT_NAME", "DEPT_LOCATION"]
