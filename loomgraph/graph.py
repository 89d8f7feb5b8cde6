"""A handle on a graph stored as chunked files: tables, operators, and SQL after attaching."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from loomgraph import operators
from loomgraph.errors import GraphBindError, GraphIOError, VertexRangeError
from loomgraph.functions.scalar import register_banner, register_paths
from loomgraph.functions.table import register_tables
from loomgraph.metadata import DEGREE_ID, EdgeInfo, GraphInfo, load_edge, load_graph
from loomgraph.operators.paths import BROADCAST_EDGES
from loomgraph.sources import reader

log = logging.getLogger("loomgraph")
#: Session setting: log the seconds that each planning step took.
TIME_LOGGING = "graph.timeLogging"
Triple = tuple[str, str, str]


@contextmanager
def timed(spark: SparkSession, what: str):
    began = time.perf_counter()
    yield
    if str(spark.conf.get(TIME_LOGGING, "false")).lower() == "true":
        log.info("%s: %.6f s", what, time.perf_counter() - began)


@lru_cache(maxsize=256)
def _cached(spark: SparkSession, path: str) -> GraphInfo:
    return load_graph(spark, path)


class Graph:
    def __init__(self, spark: SparkSession, info: GraphInfo):
        self.spark, self.info = spark, info
        self._views: list[str] = []
        self._paths = False

    @classmethod
    def load(cls, spark: SparkSession, path: str, refresh: bool = False) -> Graph:
        """The graph of a YAML file. Metadata is parsed once for each path and session."""
        if refresh:
            _cached.cache_clear()
        with timed(spark, f"load {path}"):
            return cls(spark, _cached(spark, path))

    def _edge(self, triple: Triple | None) -> EdgeInfo:
        if triple is not None:
            return self.info.edge(*triple)
        if not self.info.edges:
            raise GraphBindError("No edge of this type: the graph has no edges")
        return self.info.edges[0]

    def vertex_count(self, kind: str) -> int:
        return reader.vertex_count(self.spark, self.info, kind)

    def _check(self, kind: str, vid: int) -> int:
        if not 0 <= vid < self.vertex_count(kind):
            raise VertexRangeError(vid)
        return vid

    def vertices(self, kind: str, columns: Iterable[str] | None = None) -> DataFrame:
        with timed(self.spark, f"vertices {kind}"):
            return reader.read_vertices(self.spark, self.info, kind, columns)

    def vertex(self, kind: str, vid: int) -> DataFrame:
        """One vertex, read from its own chunk."""
        return reader.read_vertices(self.spark, self.info, kind, vid=vid)

    def edges(self, src: str, kind: str, dst: str, order: str | None = None, columns: Iterable[str] | None = None) -> DataFrame:
        with timed(self.spark, f"edges {src}_{kind}_{dst}"):
            return reader.read_edges(self.spark, self.info, (src, kind, dst), columns, order)

    def neighbors(self, triple: Triple, vid: int, direction: str = "out", columns: Iterable[str] | None = None) -> DataFrame:
        """The edges of one vertex, from the part folder of the copy that is ordered by its side; from the other copy, filtered, if that one is missing."""
        e = self.info.edge(*triple)
        side = "src" if direction == "out" else "dst"
        self._check(e.src if side == "src" else e.dst, vid)
        if e.order(side) is not None:
            return reader.read_edges(self.spark, self.info, triple, columns, side, vid)
        return operators.neighbors(reader.read_edges(self.spark, self.info, triple, columns), vid, direction)

    def _pairs(self, e: EdgeInfo) -> DataFrame:
        return reader.read_edges(self.spark, self.info, e.triple, columns=())

    def degrees(self, triple: Triple | None = None, by: str = "src") -> DataFrame:
        """(degree, id) of every vertex: from offset files where there are any, else from one count of the edges."""
        e = self._edge(triple)
        quick = reader.read_offset_degrees(self.spark, self.info.directory, e, by)
        if quick is not None:
            return quick.withColumnRenamed("vid", DEGREE_ID)
        return operators.degrees(self._pairs(e), self.vertex_count(e.src if by == "src" else e.dst), by)

    def _own(self, e: EdgeInfo, vid: int) -> DataFrame:
        """The edges from a vertex, from its part folder."""
        return self.neighbors(e.triple, vid, columns=())

    def two_hop(self, triple: Triple | None, vid: int) -> DataFrame:
        e = self._edge(triple)
        return operators.two_hop(self._pairs(e), vid, self._own(e, vid))

    def two_hop_paths(self, triple: Triple | None, vid: int) -> DataFrame:
        e = self._edge(triple)
        return operators.two_hop_paths(self._pairs(e), vid, self._own(e, vid))

    def one_more_hop(self, triple: Triple | None, vid: int) -> DataFrame:
        e = self._edge(triple)
        return operators.one_more_hop(self._pairs(e), vid, self._own(e, vid))

    def _searchable(self, triple: Triple | None) -> EdgeInfo:
        e = self._edge(triple)
        if e.src != e.dst:
            raise GraphBindError(f"Paths need edges between vertices of one type: {e.table}")
        return e

    def bfs_length(self, pairs: DataFrame, triple: Triple | None = None) -> DataFrame:
        e = self._searchable(triple)
        return operators.bfs_length(lambda: self._pairs(e), pairs, self.vertex_count(e.src))

    def bfs_exist(self, pairs: DataFrame, triple: Triple | None = None) -> DataFrame:
        e = self._searchable(triple)
        return operators.bfs_exist(lambda: self._pairs(e), pairs, self.vertex_count(e.src))

    def tables(self) -> list[str]:
        """Names of the vertex tables, then of the edge tables."""
        return [v.table for v in self.info.vertices] + [e.table for e in self.info.edges]

    def attach(self, paths: bool | None = None, alias: str | None = None, broadcast_edges: int = BROADCAST_EDGES) -> list[str]:
        """A temporary view for each table (quote their names: they hold a dot), and the SQL functions of the first edge type. Read-only.

        No edge is read here, unless for path functions: they are made at once where counts beside the edges say that there are few enough to broadcast, or with
        paths=True; else with_paths() makes them, which graph_sql calls for a statement that needs them. Tables whose files are missing are named, but have no view.
        alias: a name that the views also have before their own, as in `alias.Person.vertex`, so that several graphs can be attached.
        """
        register_banner(self.spark)
        attached = self.spark.sparkContext.__dict__.setdefault("_loomgraph_attached", {})
        attached.pop(alias or self.info.name, None)
        attached[alias or self.info.name] = self
        self._views = []
        for table, make in [(v.table, lambda v=v: self.vertices(v.type)) for v in self.info.vertices] + [(e.table, lambda e=e: self.edges(*e.triple)) for e in self.info.edges]:
            try:
                self._view(table, make(), alias)
            except GraphIOError as e:
                log.warning("%s has no view: %s", table, e)
        self._paths = False
        if self.info.edges:
            e = self.info.edges[0]
            try:
                self._view(f"{e.table}.degrees", self.degrees(e.triple), alias)
                register_tables(self.spark, e.table, f"{e.table}.degrees")
            except GraphIOError as missing:
                log.warning("%s has no functions: %s", e.table, missing)
                return self.tables()
            if e.src == e.dst and (paths or paths is None and (self._edge_count(e) or broadcast_edges + 1) <= broadcast_edges):
                self.with_paths()
        return self.tables()

    def _view(self, name: str, df: DataFrame, alias: str | None) -> None:
        for view in [name] + ([f"{alias}.{name}"] if alias else []):
            df.createOrReplaceTempView(f"`{view}`")
            self._views.append(view)

    def _edge_count(self, e: EdgeInfo) -> int | None:
        return reader.edge_count(self.spark, self.info.directory, e)

    def with_paths(self) -> None:
        """The SQL functions bfs_length and bfs_exist, if they aren't there: broadcasts the edges of the first type, in pieces if there are many."""
        if not self._paths:
            register_paths(self.spark, self._pairs(self._searchable(None)))
            self._paths = True

    def detach(self) -> None:
        for v in self._views:
            self.spark.sql(f"DROP VIEW IF EXISTS `{v}`")
        self._views, self._paths = [], False
        attached = self.spark.sparkContext.__dict__.get("_loomgraph_attached", {})
        for name in [n for n, g in attached.items() if g is self]:
            del attached[name]


def read_vertices(spark: SparkSession, path: str, type: str, columns: Iterable[str] | None = None) -> DataFrame:
    """All vertices of one type of the graph that a YAML file describes."""
    return Graph.load(spark, path).vertices(type, columns)


def read_edges(spark: SparkSession, path: str, src: str, type: str, dst: str, columns: Iterable[str] | None = None, order: str | None = None) -> DataFrame:
    """All edges of one triple of the graph that a YAML file describes."""
    return Graph.load(spark, path).edges(src, type, dst, order, columns)


def _edge_file(spark: SparkSession, path: str) -> tuple[EdgeInfo, str, DataFrame]:
    e, directory = load_edge(spark, path)
    return e, directory, reader.edges_at(spark, directory, e, columns=())


def edges_vertex(spark: SparkSession, path: str) -> DataFrame:
    """(degree, id) of every vertex, by an edge type's own YAML file."""
    e, directory, edges = _edge_file(spark, path)
    quick = reader.read_offset_degrees(spark, directory, e)
    if quick is not None:
        return quick.withColumnRenamed("vid", DEGREE_ID)
    raise GraphBindError(f"No offsets or count of vertices: {e.table}")


def two_hop(spark: SparkSession, path: str, vid: int) -> DataFrame:
    """operators.two_hop by an edge type's own YAML file."""
    return operators.two_hop(_edge_file(spark, path)[2], vid)


def one_more_hop(spark: SparkSession, path: str, vid: int) -> DataFrame:
    """operators.one_more_hop by an edge type's own YAML file."""
    return operators.one_more_hop(_edge_file(spark, path)[2], vid)
