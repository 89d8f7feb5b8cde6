"""Writing and reading chunked graphs, metadata, and SQL after attaching."""

import datetime

import pytest
from pyspark.sql import functions as F

from loomgraph import graph as api
from loomgraph.errors import GraphBindError, GraphIOError, VertexRangeError
from loomgraph.functions.scalar import banner
from loomgraph.graph import Graph
from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX, VERTEX_INDEX, spark_type
from loomgraph.sources.files import Files
from loomgraph.sources.writer import write_graph

NEXT, OWNS = ("A", "next", "A"), ("A", "owns", "B")
EDGES = [(0, 1), (0, 1), (1, 2), (1, 3), (0, 0), (8, 9), (9, 0), *[(5, i) for i in range(11)]]
OWNED = [(i % 3, i, i * 1.5, f"it's \"{i}\"" if i % 4 else None, datetime.date(2020, 1, 1 + i), i % 2 == 0) for i in range(20)]
TYPED = [(i, i * 2 if i % 5 else None, 10**12 + i, f"n'{i},\"x\"" if i % 3 else "", i / 3, i / 7, i % 2 == 0, datetime.date(2021, 2, 1 + i)) for i in range(11)]
TYPED_SQL = f"{VERTEX_INDEX} long, i int, l long, s string, f float, d double, b boolean, day date"


def typed(spark):
    return spark.createDataFrame(TYPED, TYPED_SQL)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module", params=["parquet", "csv", "orc"])
def stored(request, spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp(request.param))
    e = spark.createDataFrame(EDGES, f"{SRC_INDEX} long, {DST_INDEX} long")
    owned = spark.createDataFrame(OWNED, f"{SRC_INDEX} long, {DST_INDEX} long, price double, note string, day date, flag boolean")
    b = spark.range(20).select(F.col("id").alias(VERTEX_INDEX))
    path = write_graph(spark, at, "g", {"A": (typed(spark), [["i", "l"], ["s", "f", "d", "b", "day"]]), "B": (b, [])}, {NEXT: (e, []), OWNS: (owned, [["price", "note"], ["day", "flag"]])}, 4, 3, request.param)
    return Graph.load(spark, path), path


def test_vertices_of_two_groups_and_many_chunks(spark, stored):
    g, path = stored
    want = typed(spark)
    if g.info.vertices[0].groups[0].file_type == "csv":  # an empty string and no string are told apart by quotes
        assert rows(g.vertices("A").where("s <> ''")) == rows(want.where("s <> ''"))
    else:
        assert rows(g.vertices("A")) == rows(want)
    assert rows(api.read_vertices(spark, path, "A", ["i"])) == rows(want.select(VERTEX_INDEX, "i"))
    assert g.vertex_count("A") == 11
    assert rows(g.vertices("B")) == rows(spark.range(20))


def test_vertex_lookup_and_filters(spark, stored):
    g, _ = stored
    assert g.vertex("A", 7).select(VERTEX_INDEX, "l").first() == (7, 10**12 + 7)
    assert rows(g.vertex("B", 3)) == ["(3,)"]
    for bad in (-1, 11):
        with pytest.raises(VertexRangeError):
            g.vertex("A", bad)
    want = typed(spark)
    for c in ("b", f"{VERTEX_INDEX} = 4", "l > 1000000000003 AND i IS NOT NULL", "s = 'n''4,\"x\"'", "day = date'2021-02-03'", "i IN (2, 4)"):
        assert rows(g.vertices("A").where(c).select(VERTEX_INDEX)) == rows(want.where(c).select(VERTEX_INDEX)), c
    assert g.vertices("A").where(f"{VERTEX_INDEX} = 99").count() == 0


def test_edges_in_both_orders(spark, stored):
    g, path = stored
    want = sorted(EDGES)
    for order in ("src", "dst", None):
        assert sorted(map(tuple, g.edges(*NEXT, order=order).collect())) == want
    assert sorted(map(tuple, api.read_edges(spark, path, *NEXT).collect())) == want
    assert sorted(map(tuple, g.neighbors(NEXT, 5).collect())) == [(5, i) for i in range(11)]
    assert sorted(map(tuple, g.neighbors(NEXT, 0, "in").collect())) == sorted(x for x in EDGES if x[1] == 0)
    assert g.neighbors(NEXT, 10).count() == 0
    for d in ("out", "in"):
        with pytest.raises(VertexRangeError):
            g.neighbors(NEXT, 11, d)


def test_edge_properties_stay_with_their_edges(spark, stored):
    g, _ = stored
    owned = spark.createDataFrame(OWNED, f"{SRC_INDEX} long, {DST_INDEX} long, price double, note string, day date, flag boolean")
    for order in ("src", "dst"):
        assert rows(g.edges(*OWNS, order=order)) == rows(owned)
        assert rows(g.edges(*OWNS, order=order, columns=["flag"])) == rows(owned.select(SRC_INDEX, DST_INDEX, "flag"))
    assert rows(g.edges(*OWNS).where("price > 9 AND note IS NOT NULL")) == rows(owned.where("price > 9 AND note IS NOT NULL"))
    # an index beyond the number of sources is one of the destinations
    assert rows(g.neighbors(OWNS, 17, "in", columns=["price"])) == rows(owned.where(f"{DST_INDEX} = 17").select(SRC_INDEX, DST_INDEX, "price"))


def test_degrees_from_offsets(spark, stored, tmp_path):
    g, path = stored
    want = sorted((sum(1 for e in EDGES if e[0] == v), v) for v in range(11))
    assert sorted(map(tuple, g.degrees(NEXT).collect())) == want
    assert sorted(map(tuple, g.degrees(NEXT, by="dst").collect())) == sorted((sum(1 for e in EDGES if e[1] == v), v) for v in range(11))
    by_edge = path.rsplit("/", 1)[0] + "/A_next_A.edge.yaml"
    assert sorted(map(tuple, api.edges_vertex(spark, by_edge).collect())) == want
    assert api.edges_vertex(spark, by_edge).columns == ["degree", DEGREE_ID]
    assert api.two_hop(spark, by_edge, 0).count() == 3 + 3 + 2 * 2
    assert sorted(map(tuple, api.one_more_hop(spark, by_edge, 0).collect())) == sorted(map(tuple, g.one_more_hop(NEXT, 0).collect()))


def test_paths_on_a_stored_graph(spark, stored):
    g, _ = stored
    ask = spark.createDataFrame([(8, 2), (2, 8), (3, 3)], "src long, dst long")
    assert {(r.src, r.dst): r.bfs_length for r in g.bfs_length(ask).collect()} == {(8, 2): 4, (2, 8): -1, (3, 3): 0}
    assert {(r.src, r.dst): r.bfs_exist for r in g.bfs_exist(ask, NEXT).collect()} == {(8, 2): True, (2, 8): False, (3, 3): True}
    with pytest.raises(GraphBindError):
        g.bfs_length(ask, OWNS)
    with pytest.raises(VertexRangeError):
        g.two_hop(NEXT, 11)


def test_attach(spark, stored):
    g, _ = stored
    assert g.attach() == ["A.vertex", "B.vertex", "A_next_A.edge", "A_owns_B.edge"] == g.tables()
    assert spark.sql("SELECT count(*) FROM `a.vertex`").first()[0] == 11
    assert spark.sql(f"SELECT {VERTEX_INDEX.lower()} FROM `A.vertex` WHERE l = 1000000000004").first()[0] == 4
    assert spark.sql("SELECT count(*) FROM two_hop(vid => 0)").first()[0] == 10
    assert spark.sql("SELECT count(*) FROM two_hop_paths(0)").first()[0] == 7
    assert sorted(map(tuple, spark.sql("SELECT * FROM one_more_hop(0)").collect())) == sorted(map(tuple, g.one_more_hop(NEXT, 0).collect()))
    assert spark.sql(f"SELECT degree FROM edges_vertex() WHERE {DEGREE_ID} = 5").first()[0] == 11
    assert tuple(spark.sql("SELECT bfs_length(8L, 2L), bfs_exist(2L, 8L), bfs_length(NULL, 1L), banner('Sam')").first()) == (4, False, None, "Loomgraph Sam 🐥")
    g.detach()
    with pytest.raises(Exception):
        spark.sql("SELECT * FROM `A.vertex`").count()


def test_errors(spark, stored, tmp_path):
    g, _ = stored
    with pytest.raises(GraphIOError, match="Failed to load graph info from path"):
        Graph.load(spark, str(tmp_path / "none.yaml"))
    (tmp_path / "bad.yaml").write_text("[1, 2")
    with pytest.raises(GraphIOError):
        Graph.load(spark, str(tmp_path / "bad.yaml"))
    with pytest.raises(GraphBindError, match="No vertices of this type"):
        g.vertices("C")
    with pytest.raises(GraphBindError, match="Edges of this type are not found"):
        g.edges("A", "next", "B")
    with pytest.raises(GraphBindError, match="Unsupported type: int16"):
        spark_type("int16")
    with pytest.raises(GraphBindError, match="No such columns"):
        g.vertices("A", columns=["i", "zzz"]).count()


def test_only_asked_groups_are_read(stored):
    g, _ = stored
    plan = g.vertices("A", columns=["i"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "day" not in plan


def test_banner(spark):
    df = spark.createDataFrame([("Sam",), (None,)], "name string")
    assert [r[0] for r in df.select(banner("name")).collect()] == ["Loomgraph Sam 🐥", None]


def test_shipped_layout_of_one_csv_group(spark, tmp_path):
    """A vertex type as a single extension-less CSV chunk with a header, its type named in the metadata, without a count file."""
    d = tmp_path / "vertex" / "Person" / "number"
    d.mkdir(parents=True)
    (d / "chunk0").write_text(f'"{VERTEX_INDEX}","number"\n' + "".join(f"{i},{i}\n" for i in range(37700)))
    (tmp_path / "people.yaml").write_text("name: people\nversion: gar/v1\nvertices:\n  - Person.vertex.yaml\nedges: []\n")
    (tmp_path / "Person.vertex.yaml").write_text("type: Person\nprefix: vertex/Person/\nchunk_size: 1048576\nproperty_groups:\n  - file_type: csv\n    prefix: number/\n    properties:\n      - {name: number, data_type: int32, is_primary: true, is_nullable: false}\n")
    v = Graph.load(spark, str(tmp_path / "people.yaml")).vertices("Person")
    assert v.count() == 37700
    assert [tuple(r) for r in v.where(F.col(VERTEX_INDEX) == 0).collect()] == [(0, 0)]
    assert [tuple(r) for r in v.where("number = 42").collect()] == [(42, 42)]
    assert [r[0] for r in v.orderBy(VERTEX_INDEX).limit(4).collect()] == [0, 1, 2, 3]


def test_rows_are_numbered_alike_either_way(spark):
    import random

    from loomgraph.sources.writer import numbered

    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.randrange(6), rng.randrange(6)) for _ in range(400)]
    df = spark.createDataFrame(rows, "_p long, s long, d long").repartition(5)
    want = sorted((p, i, s, d) for p in range(3) for i, (s, d) in enumerate(sorted((s, d) for q, s, d in rows if q == p)))
    for limit in (10**6, 0):
        got = numbered(df, ["s", "d"], limit).select("_p", "_row", "s", "d").collect()
        assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("lost", ["vertex/A/i_l/chunk1", "edge/A_next_A/ordered_by_source/adj_list/part1/chunk1", "edge/A_owns_B/ordered_by_source/price_note/part0/chunk2", "edge/A_next_A/ordered_by_source/offset/chunk1"])
def test_a_missing_chunk_is_an_error(spark, tmp_path, lost):
    e = spark.createDataFrame(EDGES, f"{SRC_INDEX} long, {DST_INDEX} long")
    owned = spark.createDataFrame(OWNED, f"{SRC_INDEX} long, {DST_INDEX} long, price double, note string, day date, flag boolean")
    b = spark.range(20).select(F.col("id").alias(VERTEX_INDEX))
    path = write_graph(spark, str(tmp_path), "g", {"A": (typed(spark), [["i", "l"], ["s"]]), "B": (b, [])}, {NEXT: (e, []), OWNS: (owned, [["price", "note"]])}, 4, 3)
    g = Graph.load(spark, path)
    reads = [lambda: g.vertices("A", ["i"]), lambda: g.edges(*NEXT), lambda: g.edges(*OWNS, columns=["price"]), lambda: g.degrees(NEXT)]
    before = [r().count() for r in reads]
    (tmp_path / lost).unlink()
    failed = []
    for k, r in enumerate(reads):
        try:
            assert r().count() == before[k]
        except GraphIOError as error:
            assert "are there" in str(error)
            failed.append(k)
    assert failed == [["vertex/A", "A_next_A/ordered_by_source/adj_list", "A_owns_B", "offset"].index(next(x for x in ("vertex/A", "A_next_A/ordered_by_source/adj_list", "A_owns_B", "offset") if x in lost))]
    if "adj_list" in lost:
        with pytest.raises(GraphIOError):
            g.neighbors(NEXT, 5)


def test_a_part_without_edges(spark, tmp_path):
    e = spark.createDataFrame([(0, 1)], f"{SRC_INDEX} long, {DST_INDEX} long")
    v = spark.range(9).select(F.col("id").alias(VERTEX_INDEX))
    g = Graph.load(spark, write_graph(spark, str(tmp_path), "g", {"A": (v, [])}, {NEXT: (e, [])}, 4, 3))
    assert g.neighbors(NEXT, 7).count() == 0 and g.two_hop(NEXT, 7).count() == 0 and g.neighbors(NEXT, 1, "in").count() == 1
    none = Graph.load(spark, write_graph(spark, str(tmp_path / "none"), "g", {"A": (v, [])}, {NEXT: (e.limit(0), [])}, 4, 3))
    assert none.edges(*NEXT).count() == 0 and none.neighbors(NEXT, 0).count() == 0 and none.edges(*NEXT).columns == [SRC_INDEX, DST_INDEX]


def test_errors_of_the_store_are_not_swallowed(spark, tmp_path, monkeypatch):
    from loomgraph.sources import reader
    from loomgraph.sources.files import Files

    assert reader.read_count(spark, str(tmp_path / "none")) is None
    monkeypatch.setattr(Files, "get", lambda self, path: (_ for _ in ()).throw(PermissionError(path)))
    with pytest.raises(PermissionError):
        reader.read_count(spark, str(tmp_path / "none"))


def test_counts_of_very_many_parts(spark, stored, monkeypatch):
    from loomgraph.sources import reader

    g, _ = stored
    e = g.info.edge(*NEXT)
    few = [reader.chunks_of_edges(spark, g.info.directory, e, o) for o in e.orders]
    monkeypatch.setattr(reader, "FEW_PARTS", 0)
    assert [reader.chunks_of_edges(spark, g.info.directory, e, o) for o in e.orders] == few
    assert reader.edge_count(spark, g.info.directory, e) == len(EDGES)


def test_first_hop_is_read_from_its_part(spark, stored):
    g, _ = stored
    files = g._own(g.info.edge(*NEXT), 5).inputFiles()
    assert files and all("part1" in f for f in files)


def test_times_are_logged(spark, stored, caplog):
    import logging

    g, _ = stored
    caplog.set_level(logging.INFO, "loomgraph")
    g.vertices("B")
    assert not caplog.records
    spark.conf.set("graph.timeLogging", "true")
    try:
        g.vertices("B")
    finally:
        spark.conf.unset("graph.timeLogging")
    assert any(r.name == "loomgraph" and "vertices B" in r.getMessage() for r in caplog.records)


N = 2000


@pytest.fixture(scope="module")
def dealt(spark, tmp_path_factory):
    """A graph of 125 chunks of vertices that several tasks write, and its edges."""
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in conf}
    e = spark.range(3 * N).select((F.col("id") * F.col("id") % N).alias(SRC_INDEX), (F.col("id") * 7 % N).alias(DST_INDEX))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        path = write_graph(spark, str(tmp_path_factory.mktemp("dealt")), "g", {"A": (spark.range(N).select(F.col("id").alias(VERTEX_INDEX)), [])}, {NEXT: (e, [])}, 16, 1000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return Graph.load(spark, path), e


def counted(e, column=SRC_INDEX):
    return {v: 0 for v in range(N)} | {r[0]: r[1] for r in e.groupBy(column).count().collect()}


def test_offsets_written_by_several_tasks(dealt):
    g, e = dealt
    for by, column in (("src", SRC_INDEX), ("dst", DST_INDEX)):
        got = g.degrees(NEXT, by).collect()
        assert len(got) == N and {r[DEGREE_ID]: r["degree"] for r in got} == counted(e, column)


def test_degrees_in_sql_of_a_graph_written_by_several_tasks(spark, dealt):
    g, e = dealt
    g.attach(paths=False)
    got = spark.sql(f"SELECT {DEGREE_ID}, degree FROM edges_vertex() WHERE degree > 2").collect()
    g.detach()
    assert sorted(map(tuple, got)) == sorted((v, n) for v, n in counted(e).items() if n > 2)


def test_distribution_over_a_graph_written_by_several_tasks(dealt):
    from loomgraph import operators as ops

    g, e = dealt
    want = {}
    for n in counted(e).values():
        want[n] = want.get(n, 0) + 1
    assert {r["degree"]: r["vertices"] for r in ops.degree_distribution(g.degrees(NEXT)).collect()} == want


def test_two_files_of_one_chunk_are_refused(spark, tmp_path):
    tmp, to = f"{tmp_path}/x.writing", f"{tmp_path}/x/"
    for _ in range(2):
        spark.range(3).withColumn("_d0", F.lit(0)).write.partitionBy("_d0").mode("append").parquet(tmp)
    with pytest.raises(GraphIOError, match="chunk0"):
        Files(spark, to).settle(tmp, to)
