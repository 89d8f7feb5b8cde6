"""Operators on hand-written graphs."""

import random

import pytest

from loomgraph import operators as ops
from loomgraph.errors import VertexRangeError
from loomgraph.functions.scalar import path_udf, register_paths
from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX

PATH = [(0, 1), (1, 2), (2, 3), (3, 4)]
CYCLE = [(0, 1), (1, 2), (2, 0)]
MULTI = [(0, 1), (0, 1), (1, 2), (1, 3), (0, 0)]
TRIANGLE = [(0, 1), (0, 2), (1, 2), (2, 3)]


def edges(spark, rows):
    return spark.createDataFrame(rows, f"{SRC_INDEX} long, {DST_INDEX} long")


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def brute_two_hop(rows, v):
    first = [e for e in rows if e[0] == v]
    return sorted(first + [e for f in first for e in rows if e[0] == f[1]])


def test_two_hop_keeps_multiplicity(spark):
    got = pairs(ops.two_hop(edges(spark, MULTI), 0))
    assert len(got) == 10 and got == brute_two_hop(MULTI, 0)
    assert pairs(ops.two_hop(edges(spark, MULTI), 3)) == []


def test_two_hop_paths(spark):
    assert pairs(ops.two_hop_paths(edges(spark, PATH), 0)) == [(0, 1, 2)]
    assert len(pairs(ops.two_hop_paths(edges(spark, MULTI), 0))) == 7


def test_one_more_hop_closes_triangles(spark):
    assert pairs(ops.one_more_hop(edges(spark, TRIANGLE), 0)) == [(0, 1), (0, 2), (1, 2)]
    assert pairs(ops.one_more_hop(edges(spark, MULTI), 0)) == sorted([(0, 0), (0, 1), (0, 1)] + [(0, 0), (0, 1), (0, 1)])


def test_random_graphs_against_brute_force(spark):
    rng = random.Random(1)
    for _ in range(3):
        rows = [(rng.randrange(12), rng.randrange(12)) for _ in range(60)]
        e = edges(spark, rows)
        assert pairs(ops.two_hop(e, 3)) == brute_two_hop(rows, 3)
        around = {d for s, d in rows if s == 3}
        assert pairs(ops.one_more_hop(e, 3)) == sorted([x for x in rows if x[0] == 3] + [x for x in rows if x[0] in around and x[1] in around])


def test_neighbors(spark):
    e = edges(spark, MULTI)
    assert pairs(ops.neighbors(e, 0)) == [(0, 0), (0, 1), (0, 1)]
    assert pairs(ops.neighbors(e, 0, "in")) == [(0, 0)]
    with pytest.raises(ValueError):
        ops.neighbors(e, 0, "up")


def test_degrees_of_isolated_vertices(spark):
    got = {r[DEGREE_ID]: r["degree"] for r in ops.degrees(edges(spark, CYCLE + [(2, 0)]), 6).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 0, 4: 0, 5: 0}
    assert {r[DEGREE_ID]: r["degree"] for r in ops.degrees(edges(spark, CYCLE), 4, by="dst").collect()} == {0: 1, 1: 1, 2: 1, 3: 0}


def test_max_degree_and_distribution(spark):
    table = ops.degrees(edges(spark, TRIANGLE), 4)
    assert tuple(ops.max_degree(table).first()) == (2, 0)
    assert pairs(ops.degree_distribution(table)) == [(0, 1), (1, 2), (2, 1)]
    assert ops.max_degree(ops.degrees(edges(spark, []), 0)).count() == 0


def brute_bfs(rows, s, d):
    depth, seen, front = 0, {s}, {s}
    while front:
        if d in front:
            return depth
        front = {b for a, b in rows if a in front} - seen
        seen |= front
        depth += 1
    return -1


@pytest.mark.parametrize("limit", [10**6, 0])
def test_bfs_both_ways(spark, limit):
    rng = random.Random(2)
    rows = [(rng.randrange(20), rng.randrange(20)) for _ in range(25)] + [(0, 0), (0, 1), (0, 1)]
    asked = [(s, d) for s in (0, 5, 7) for d in range(20)] + [(0, 1), (None, 3), (3, None)]
    got = ops.bfs_length(edges(spark, rows), spark.createDataFrame(asked, "src long, dst long"), 20, broadcast_edges=limit).collect()
    assert len(got) == len(asked)
    for r in got:
        want = None if r.src is None or r.dst is None else brute_bfs(rows, r.src, r.dst)
        assert r.bfs_length == want, r


@pytest.mark.parametrize("limit", [10**6, 0])
def test_bfs_corner_cases(spark, limit):
    e = edges(spark, PATH)
    ask = lambda *p: spark.createDataFrame(list(p), "src long, dst long, tag string")
    got = {r.tag: r.bfs_length for r in ops.bfs_length(e, ask((0, 4, "far"), (4, 0, "back"), (4, 4, "self"), (9, 9, "alone")), broadcast_edges=limit).collect()}
    assert got == {"far": 4, "back": -1, "self": 0, "alone": 0}
    got = {r.tag: r.bfs_exist for r in ops.bfs_exist(edges(spark, CYCLE), ask((0, 2, "a"), (0, 4, "b")), 5, broadcast_edges=limit).collect()}
    assert got == {"a": True, "b": False}
    with pytest.raises(VertexRangeError):
        ops.bfs_length(e, ask((0, 5, "out")), 5, broadcast_edges=limit)
    assert ops.bfs_length(edges(spark, []), ask((0, 1, "x")), broadcast_edges=limit).first().bfs_length == -1


@pytest.mark.parametrize("limit", [10**6, 0])
def test_next_edges(spark, limit):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, *range(9)]), rng.randrange(5)) for k in range(300)]
    got = pairs(ops.next_edges(spark.createDataFrame(rows, "k long, v long, t long").repartition(5), "v", ["t", "k"], one_task_rows=limit))
    order = [v for k, v, t in sorted(rows, key=lambda r: (r[2], r[0]))]
    assert got == sorted((a, b) for a, b in zip(order, order[1:]) if a is not None and b is not None)


def test_two_hop_pushes_its_filter_and_keeps_two_columns(spark, tmp_path):
    edges(spark, MULTI).selectExpr("*", "1 AS weight").write.parquet(str(tmp_path / "e"))
    plan = ops.two_hop(spark.read.parquet(str(tmp_path / "e")), 0)._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo({SRC_INDEX},0)" in plan and "weight" not in plan


def test_scalar_paths_of_a_graph_in_pieces(spark):
    chain = [(i, i + 1) for i in range(30)] + [(i, i * 7 % 31) for i in range(0, 30, 4)] + [(40, 41)]
    asked = spark.createDataFrame([(s, d) for s in (0, 3, 9, 17, 28, 40, None) for d in [*range(0, 42, 3), None]], "src long, dst long").repartition(3)
    want = ops.bfs_length(edges(spark, chain), asked)
    length = path_udf(edges(spark, chain), limit=10, piece=7)
    got = asked.select("src", "dst", length("src", "dst").alias("bfs_length"))
    key = lambda r: tuple(-9 if x is None else x for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    register_paths(spark, edges(spark, chain), limit=10)
    assert tuple(spark.sql("SELECT bfs_length(0, 2), bfs_exist(40, 0), bfs_exist(0, 30), bfs_length(NULL, 1)").first()) == (2, False, True, None)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_many_pairs_and_few(spark, limit, monkeypatch):
    from loomgraph.operators import paths

    rng = random.Random(4)
    rows = [(rng.randrange(30), rng.randrange(30)) for _ in range(45)]
    asked = [(s, d) for s in range(6) for d in range(30)] + [(None, 1)]
    want = {(s, d): None if s is None else brute_bfs(rows, s, d) for s, d in asked}
    for few in (0, 1000):
        monkeypatch.setattr(paths, "FEW_PAIRS", few)
        got = ops.bfs_length(edges(spark, rows), spark.createDataFrame(asked, "src long, dst long"), 30, broadcast_edges=limit).collect()
        assert {(r.src, r.dst): r.bfs_length for r in got} == want and len(got) == len(asked)
        with pytest.raises(VertexRangeError):
            ops.bfs_length(edges(spark, rows), spark.createDataFrame([(0, 1), (1, 30)], "src long, dst long"), 30, broadcast_edges=limit)


def test_pairs_of_one_vertex_need_no_edges(spark):
    broken = edges(spark, PATH).where("raise_error('read') IS NULL")
    ask = spark.createDataFrame([(3, 3), (None, 2)], "src long, dst long")
    assert sorted(map(str, (r.bfs_length for r in ops.bfs_length(broken, ask, 5).collect()))) == ["0", "None"]


def test_deep_graphs_keep_small_plans(spark, monkeypatch):
    from loomgraph.operators import paths

    monkeypatch.setattr(paths, "LEVELS", 3)
    chain = [(i, i + 1) for i in range(10)]
    got = paths.bfs_levels(edges(spark, chain), spark.createDataFrame([(0,), (4,)], "src long"))
    assert sorted(map(tuple, got.collect())) == sorted([(0, i, i) for i in range(11)] + [(4, i, i - 4) for i in range(4, 11)])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 4


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from loomgraph.errors import GraphIOError
    from loomgraph.plans import lineage

    def session(master, given=None):
        conf = SimpleNamespace(get=lambda name, default=None: given, set=lambda name, value: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    for master in ("spark://somewhere:7077", "local-cluster[3,2,1024]", "yarn"):
        with pytest.raises(GraphIOError, match="spark.checkpoint.dir"):
            lineage.shared_dir(session(master))
        assert lineage.shared_dir(session(master, "hdfs://x/y/")) == "hdfs://x/y"
    assert lineage.shared_dir(session("local[4]")) == lineage.FALLBACK_DIR
