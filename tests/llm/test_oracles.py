"""The queries that SQL can express, against DuckDB over a whole small table."""

import collections

import duckdb
import pytest

from loadsmith.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name, sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in rel.description]
    want = collections.Counter(rel.fetchall())
    rows = QUERIES[name](spark, sf)
    assert sorted(rows.columns) == sorted(columns)
    assert collections.Counter(tuple(r[c] for c in columns) for r in rows.collect()) == want


def test_all_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
