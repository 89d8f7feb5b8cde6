"""Neighbours, two-hop expansion and triangle-closing edges. Edges are a multiset of (src, dst): parallel edges count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.metadata import DST_INDEX, SRC_INDEX
from loomgraph.plans.lineage import broadcast_if_small


def _ids(edges: DataFrame) -> DataFrame:
    return edges.select(SRC_INDEX, DST_INDEX)


def neighbors(edges: DataFrame, vid: int, direction: str = "out") -> DataFrame:
    """The edges that leave (out) or enter (in) a vertex. The filter reaches the scan."""
    if direction not in ("out", "in"):
        raise ValueError("direction is out or in")
    return edges.where(F.col(SRC_INDEX if direction == "out" else DST_INDEX) == vid)


def _second(edges: DataFrame, first: DataFrame) -> DataFrame:
    """One vertex's edges joined with those that leave their ends: (src, dst, end), once for each pair of edges."""
    steps = _ids(first).withColumnRenamed(DST_INDEX, "_via").withColumnRenamed(SRC_INDEX, "_from")
    return broadcast_if_small(steps).join(_ids(edges), F.col("_via") == F.col(SRC_INDEX))


def _first(edges: DataFrame, vid: int, own: DataFrame | None) -> DataFrame:
    return _ids(neighbors(edges, vid) if own is None else own)


def two_hop(edges: DataFrame, vid: int, own: DataFrame | None = None) -> DataFrame:
    """The edges from vid, and for each of them, with multiplicity, the edges that go on from its end. own: the edges from vid, where they can be read apart from the others."""
    first = _first(edges, vid, own)
    return first.unionAll(_second(edges, first).select(SRC_INDEX, DST_INDEX))


def two_hop_paths(edges: DataFrame, vid: int, own: DataFrame | None = None) -> DataFrame:
    """(src, mid, dst) for every path of two edges from vid."""
    first = _first(edges, vid, own)
    return _second(edges, first).select(F.col("_from").alias("src"), F.col("_via").alias("mid"), F.col(DST_INDEX).alias("dst"))


def closing_edges(edges: DataFrame, vid: int, own: DataFrame | None = None) -> DataFrame:
    """The edges between neighbours of vid, that close triangles through it."""
    around = broadcast_if_small(_first(edges, vid, own).select(F.col(DST_INDEX).alias("_n")).distinct())
    e = _ids(edges)
    return e.join(around, e[SRC_INDEX] == around["_n"], "left_semi").join(around, e[DST_INDEX] == around["_n"], "left_semi")


def one_more_hop(edges: DataFrame, vid: int, own: DataFrame | None = None) -> DataFrame:
    """The edges from vid and those between its neighbours."""
    return _first(edges, vid, own).unionAll(closing_edges(edges, vid, own))
