"""Scalar functions: the banner, and path lengths of a graph whose edges are broadcast, in pieces if there are many."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators.paths import BROADCAST_EDGES, UNREACHED, Adjacency, _ids
from loomgraph.plans.lineage import at_most, ship

NAME = "Loomgraph"
#: Edges of one piece of a graph that is too large to be held as a whole, and sources whose distances a task keeps.
PIECE_EDGES, KEPT_SOURCES = 1_000_000, 4


def banner(name: Column | str) -> Column:
    """A greeting; null for null."""
    return F.concat(F.lit(f"{NAME} "), F.col(name) if isinstance(name, str) else name, F.lit(" 🐥"))


class Pieces(Adjacency):
    """Edges in broadcast pieces, of which one is held at a time."""

    def __init__(self, pieces: list[Broadcast]):
        self.pieces = pieces

    def after(self, frontier: np.ndarray) -> np.ndarray:
        found = frontier[:0]
        for b in self.pieces:
            found = np.union1d(found, b.value.after(frontier))
            if len(self.pieces) > 1 and getattr(b, "_path", None):  # without a path the value can't be read again
                del b._value
        return found


class Search:
    """Distances from one vertex, found as far as they have been asked for."""

    def __init__(self, graph: Adjacency, source: int):
        self.graph = graph
        self.seen = np.array([source], dtype=np.int64)
        self.levels = [self.seen]

    def lengths(self, targets: np.ndarray) -> np.ndarray:
        out = np.full(len(targets), UNREACHED, dtype=np.int64)
        left, depth = np.arange(len(targets)), 0
        while len(left):
            if depth == len(self.levels):
                new = np.setdiff1d(self.graph.after(self.levels[-1]), self.seen, assume_unique=True)
                self.seen = np.union1d(self.seen, new)
                self.levels.append(new)
            level = self.levels[depth]
            if not len(level):  # the last one, which ends the search
                break
            here = np.isin(targets[left], level)
            out[left[here]] = depth
            left, depth = left[~here], depth + 1
        return out


def _dealt(edges: DataFrame, size: int) -> list[Broadcast]:
    """The edges in broadcast pieces of about so many. They pass through the driver one by one."""
    rows = _ids(edges).where("s IS NOT NULL AND d IS NOT NULL")
    spark = edges.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            s, d = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array([s.tobytes()], pa.binary()), pa.array([d.tobytes()], pa.binary())], names=["s", "d"])

    packed = rows.repartition(max(1, -(-rows.count() // size))).mapInArrow(pack, "s binary, d binary")
    return [spark.sparkContext.broadcast(Adjacency(np.frombuffer(r["s"], np.int64), np.frombuffer(r["d"], np.int64))) for r in packed.toLocalIterator()]


def path_udf(edges: DataFrame, limit: int = BROADCAST_EDGES, piece: int = PIECE_EDGES) -> Callable[..., Column]:
    """bfs_length(src, dst) as a vectorised function over broadcast edges. Up to limit edges are held as a whole, more in pieces on the executors' disks.

    A graph in pieces is read once for each level of each source in a task, so for large tables of pairs operators.bfs_length is the faster way.
    """
    ship(edges.sparkSession)
    if at_most(_ids(edges), limit):
        got = _ids(edges).toArrow()
        shared = [edges.sparkSession.sparkContext.broadcast(Adjacency(got.column("s").to_numpy(), got.column("d").to_numpy()))]
    else:
        shared = _dealt(edges, piece)

    @F.pandas_udf("long")
    def bfs_length(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        graph = Pieces(shared)
        kept: dict[int, Search] = {}  # the latest last
        for src, dst in batches:
            out = pd.array([None] * len(src), dtype="Int64")
            known = (src.notna() & dst.notna()).to_numpy()
            frame = pd.DataFrame({"s": src[known].astype("int64").to_numpy(), "d": dst[known].astype("int64").to_numpy()}, index=np.flatnonzero(known))
            for s, own in frame.groupby("s"):
                search = kept.pop(int(s), None) or Search(graph, int(s))
                out[own.index.to_numpy()] = search.lengths(own["d"].to_numpy())
                kept[int(s)] = search
                if len(kept) > KEPT_SOURCES:
                    del kept[next(iter(kept))]
            yield pd.Series(out)

    return bfs_length


def register_paths(spark: SparkSession, edges: DataFrame, limit: int = BROADCAST_EDGES) -> None:
    """bfs_length(s, d) and bfs_exist(s, d) for SQL, on one graph."""
    length = path_udf(edges, limit)
    spark.udf.register("_bfs_length", length)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION bfs_length(s BIGINT, d BIGINT) RETURNS BIGINT RETURN _bfs_length(s, d)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION bfs_exist(s BIGINT, d BIGINT) RETURNS BOOLEAN RETURN _bfs_length(s, d) <> -1")


def register_banner(spark: SparkSession) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION banner(name STRING) RETURNS STRING RETURN concat('{NAME} ', name, ' 🐥')")
