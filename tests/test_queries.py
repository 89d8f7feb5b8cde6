"""The registered queries of the graph engine against their SQL in DuckDB, at the smallest scale."""

import os

import duckdb
import pytest

from loomgraph.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def told(row):
    return tuple(round(v, 6) if isinstance(v, float) else str(v) for v in row)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(told(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    assert got == sorted(told(r[i] for i in order) for r in rel.fetchall())


def test_bfs_functions_of_many_edges(spark, duck, monkeypatch):
    from loomgraph.sources import reader

    for f in ("bfs_length", "bfs_exist"):
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {f}")
    monkeypatch.setattr(reader, "edge_count", lambda *_: 10**9)
    got = QUERIES["bfs_functions"](spark, SF).select("id", "bfs_length", "bfs_exist").collect()
    assert sorted(map(tuple, got)) == sorted(duck.sql(f"SELECT id, bfs_length, bfs_exist FROM ({ORACLES['bfs_functions']})").fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 186
    assert set(e.oracle_sql()) <= set(e.queries())
