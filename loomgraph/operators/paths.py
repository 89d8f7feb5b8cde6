"""Breadth-first shortest paths over directed edges, for many pairs at once.

A few pairs are looked for among the edges from their sources first, which pushes down to the scan. For the others, small graphs (by a count of their edges) are broadcast as sorted arrays, and each pair is searched where it lies. Larger ones are
traversed level by level: the frontier (source, vertex) is joined with the edges, reached vertices are left out by an anti
join, and every level is written to the shared folder, so that a lost executor costs no more than its level. A source whose pairs all have answers is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.errors import VertexRangeError
from loomgraph.metadata import DST_INDEX, SRC_INDEX
from loomgraph.plans.lineage import at_most, broadcast_if_small, materialize, ship

#: Edges up to this number are broadcast: 8 bytes each.
BROADCAST_EDGES = 4_000_000
UNREACHED = -1
#: Pairs up to this number are answered from the edges of their sources alone, if they are one edge apart.
FEW_PAIRS = 64
#: Pairs with one source that a task searches for at a time, and levels after which the tables of a traversal are made one.
TARGETS, LEVELS = 100_000, 8


class Adjacency:
    """Edges sorted by their start, as arrays."""

    def __init__(self, src: np.ndarray, dst: np.ndarray):
        order = np.argsort(src, kind="stable")
        self.starts, first = np.unique(src[order], return_index=True)
        self.bounds = np.append(first, len(src))
        self.ends = dst[order]

    def after(self, frontier: np.ndarray) -> np.ndarray:
        """The distinct ends of edges from a sorted frontier."""
        at = np.searchsorted(self.starts, frontier)
        at = at[(at < len(self.starts)) & (self.starts[np.minimum(at, len(self.starts) - 1)] == frontier)] if len(self.starts) else at[:0]
        n = self.bounds[at + 1] - self.bounds[at]
        where = np.repeat(self.bounds[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.unique(self.ends[where])

    def levels(self, source: int, targets: set[int]) -> dict[int, int]:
        """Distances of those targets that are reached; stops when all are."""
        frontier = seen = np.array([source], dtype=np.int64)
        found, depth = ({source: 0} if source in targets else {}), 0
        while len(frontier) and len(found) < len(targets):
            depth += 1
            frontier = np.setdiff1d(self.after(frontier), seen, assume_unique=True)
            seen = np.union1d(seen, frontier)
            found.update((t, depth) for t in targets.intersection(frontier.tolist()))
        return found


def _ids(edges: DataFrame) -> DataFrame:
    return edges.select(F.col(SRC_INDEX).cast("long").alias("s"), F.col(DST_INDEX).cast("long").alias("d"))


def _broadcast(pairs: DataFrame, edges: DataFrame, slices: int = 8) -> DataFrame:
    ship(edges.sparkSession)
    got = _ids(edges).toArrow()
    shared = edges.sparkSession.sparkContext.broadcast((got.column("s").to_numpy(), got.column("d").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Adjacency(*shared.value)
        for batch in batches:
            for src, dsts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                known = graph.levels(src, set(dsts))
                yield pa.RecordBatch.from_arrays([pa.array([src] * len(dsts), pa.int64()), pa.array(dsts, pa.int64()), pa.array([known.get(d, UNREACHED) for d in dsts], pa.int64())], names=["src", "dst", "bfs_length"])

    # a source with very many targets is searched in several tasks
    by_source = pairs.groupBy("src", F.pmod(F.xxhash64("dst"), F.lit(slices)).alias("_slice")).agg(F.collect_set("dst").alias("dsts"))
    return by_source.select("src", "dsts").mapInArrow(run, "src long, dst long, bfs_length long")


def bfs_levels(edges: DataFrame, sources: DataFrame, targets: DataFrame | None = None, max_depth: int | None = None) -> DataFrame:
    """(src, vertex, depth) for all that sources(src) reach. With targets(src, dst), a source goes on only until all its targets are reached."""
    e = materialize(_ids(edges).distinct(), "bfs-edges")  # read once a level, made once
    level = materialize(sources.select(F.col("src").cast("long").alias("src")).where("src IS NOT NULL").distinct().select("src", F.col("src").alias("vertex")), "bfs")
    levels = [level.withColumn("depth", F.lit(0).cast("long"))]
    seen, left, depth = level, targets, 0
    while max_depth is None or depth < max_depth:
        if left is not None:
            left = materialize(left.join(level.withColumnRenamed("vertex", "dst"), ["src", "dst"], "left_anti"), "bfs-left")
            level = level.join(left.select("src").distinct(), "src", "left_semi")
        ahead = e.join(broadcast_if_small(level), F.col("vertex") == F.col("s"))  # a small frontier spares a shuffle of the edges
        ahead = ahead.select("src", F.col("d").alias("vertex")).distinct()
        level = materialize(ahead.join(seen, ["src", "vertex"], "left_anti"), "bfs")
        if level.isEmpty():
            break
        depth += 1
        levels.append(level.withColumn("depth", F.lit(depth).cast("long")))
        seen = seen.unionByName(level)
        if depth % LEVELS == 0:  # plans must not grow with the depth of a graph
            levels = [materialize(reduce(DataFrame.unionByName, levels), "bfs-levels")]
            seen = levels[0].select("src", "vertex")
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def bfs_length(edges: DataFrame | Callable[[], DataFrame], pairs: DataFrame, vertices: int | None = None, broadcast_edges: int = BROADCAST_EDGES) -> DataFrame:
    """pairs(src, dst, ...) with bfs_length: the least number of edges from src to dst, 0 from a vertex to itself, -1 if there is no path; null for null ids.

    edges: also as a function that reads them, which isn't called where no pair needs it. vertices: the number of vertices; an id outside raises VertexRangeError.
    """
    read = edges if callable(edges) else lambda: edges
    some = pairs.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    few = some.limit(FEW_PAIRS + 1).collect()
    if len(few) <= FEW_PAIRS:
        return _of_few(read, pairs, [tuple(r) for r in few], vertices, broadcast_edges)
    if vertices is not None:
        outside = pairs.where(~F.col("src").between(0, vertices - 1) | ~F.col("dst").between(0, vertices - 1)).select("src", "dst").first()
        if outside is not None:
            raise VertexRangeError(tuple(outside))
    asked = some.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct()
    return _with_lengths(pairs, _search(read(), asked, broadcast_edges))


def _search(edges: DataFrame, asked: DataFrame, broadcast_edges: int, few: bool = False) -> DataFrame:
    """(src, dst, bfs_length) of distinct pairs; those without a path have UNREACHED or no row."""
    small = at_most(_ids(edges), broadcast_edges)
    if small and few:
        return _broadcast(asked, edges, 1)
    asked = materialize(asked, "pairs")
    if small:
        return _broadcast(asked, edges, max(8, asked.count() // TARGETS))
    reached = bfs_levels(edges, asked, asked).select("src", F.col("vertex").alias("dst"), F.col("depth").alias("bfs_length"))
    return asked.join(reached, ["src", "dst"])


def _of_few(read: Callable[[], DataFrame], pairs: DataFrame, few: list[tuple], vertices: int | None, broadcast_edges: int) -> DataFrame:
    """bfs_length() of pairs that hold these few alone."""
    spark = pairs.sparkSession
    if vertices is not None:
        for p in few:
            if any(v is not None and not 0 <= v < vertices for v in p):
                raise VertexRangeError(p)
    asked = {p for p in few if None not in p and p[0] != p[1]}
    found: dict[tuple, int] = {}
    if asked:
        edges = read()
        near = _ids(edges).where(F.col("s").isin(sorted({s for s, _ in asked})) & F.col("d").isin(sorted({d for _, d in asked})))
        found = dict.fromkeys(asked & {tuple(r) for r in near.groupBy("s", "d").agg(F.lit(1)).select("s", "d").collect()}, 1)
        if left := asked - found.keys():
            rest = _search(edges, spark.createDataFrame(sorted(left), "src long, dst long"), broadcast_edges, few=True)
            return _with_lengths(pairs, F.broadcast(spark.createDataFrame([(*p, n) for p, n in found.items()], "src long, dst long, bfs_length long").unionByName(rest)))
    length = F.lit(None).cast("long")
    for (s, d), n in found.items():
        length = F.when((F.col("src") == s) & (F.col("dst") == d), n).otherwise(length)
    return pairs.select(*pairs.columns, _told(length).alias("bfs_length"))


def _told(length) -> Column:
    """The length of a row's pair, given what was found for it."""
    known = F.when(F.col("src").isNull() | F.col("dst").isNull(), None).when(F.col("src") == F.col("dst"), 0).otherwise(F.coalesce(length, F.lit(UNREACHED)))
    return known.cast("long")


def _with_lengths(pairs: DataFrame, found: DataFrame) -> DataFrame:
    out = pairs.join(found, ["src", "dst"], "left").select(*pairs.columns, F.col("bfs_length").alias("_found"))
    return out.select(*pairs.columns, _told(F.col("_found")).alias("bfs_length"))


def bfs_exist(edges: DataFrame | Callable[[], DataFrame], pairs: DataFrame, vertices: int | None = None, broadcast_edges: int = BROADCAST_EDGES) -> DataFrame:
    """pairs(src, dst, ...) with bfs_exist: whether dst can be reached from src."""
    return bfs_length(edges, pairs, vertices, broadcast_edges).withColumn("bfs_exist", F.col("bfs_length") != UNREACHED).drop("bfs_length")
