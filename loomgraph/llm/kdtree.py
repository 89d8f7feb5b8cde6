"""Exact top-k by integer inner product, with a KD-tree for each shard.

Vectors are sorted by a grid on their principal axes and cut into shards of bounded size, each with the tight bounding box of its vectors. A shard's tree splits at the median of its
widest component down to leaves, with the tight bounding box of every node. The largest inner product that a query can have in a box bounds what it holds: per query, nodes are
taken best first until no bound reaches the k-th best score. The boxes of all shards are broadcast (their size is bounded: shards grow if there are too many). Every query goes to the shard of its
largest bound first, then, with the k-th score found there, to those others alone whose bound reaches that. So queries travel, a shard's vectors once for each of the two rounds, and
a task builds a shard's tree once.

Vectors that are null, or hold null or non-finite components take no part. Queries meet vectors of their own dimension: the search runs once for each
that occurs. Rows without a vec_id are left out; rows repeated under one vec_id all count, as candidates and as queries, whose results are ranked together; rows of
one id don't meet. A table without rows gives none. Columns other than vec_id and embedding are ignored.
Products are exact and ranked as such, whatever their size; a score that leaves the range of a long is given as the end of that range. Components that leave
the range of a double when they are scaled are cut to it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import materialize, partitions, prepare
from loomgraph.llm.egojoin import principal_axes
from loomgraph.llm.vectors import dimensions, matrix, rows_of

SCALE = 256
EXACT = 1 << 53  # whole numbers that doubles hold without a gap
SHARD, LEAF, QUERIES = 8192, 128, 512
#: Bytes of all shards' boxes together: shards are made as large as it takes.
BOX_BYTES = 64 << 20
#: Bounds of queries and boxes that a task holds at a time.
BOUNDS = 1 << 21
CELLS, WIDTH = 4, 0.25  # axes of the grid that vectors are sorted by, and the width of its cells
LARGEST = 1 << 31  # components below it are kept in four bytes
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


class KdTree:
    """Node i of rows first[i] to last[i] has its box in lo[i], hi[i] and its two parts in kids[i] (-1, -1 at a leaf)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.first: list[int] = []
        self.last: list[int] = []
        self.kids: list[tuple[int, int]] = []
        rows = np.arange(len(ids))
        lo, hi = [], []
        todo = [(0, len(ids), None)]
        while todo:
            a, b, parent = todo.pop()
            here = len(self.first)
            if parent is not None:
                k = self.kids[parent]
                self.kids[parent] = (here, k[1]) if k[0] < 0 else (k[0], here)
            part = self.x[rows[a:b]]
            lo.append(part.min(0))
            hi.append(part.max(0))
            self.first.append(a)
            self.last.append(b)
            self.kids.append((-1, -1))
            if b - a > LEAF:
                axis = int((hi[-1] - lo[-1]).argmax())
                m = (b - a) // 2
                rows[a:b] = rows[a:b][np.argpartition(part[:, axis], m)]
                todo += [(a, a + m, here), (a + m, b, here)]
        self.ids, self.x = self.ids[rows], self.x[rows]
        self.lo, self.hi = np.array(lo), np.array(hi)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The largest product with anything in each node's box, for each query."""
        up, down = dot(np.maximum(q, 0), self.hi.T), dot(np.minimum(q, 0), self.lo.T)
        return up + down if up.dtype == down.dtype else exact(up) + exact(down)

    def search(self, q: np.ndarray, own: int, bound: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, vec_id) but own, best first, ties to the smaller id; may leave out what is below least."""
        best: list[tuple[int, int]] = []  # (score, -id), worst first
        queue = [(-int(bound[0]), 0)]
        while queue:
            top, node = heapq.heappop(queue)
            limit = best[0][0] if len(best) == k else None
            if least is not None and (limit is None or least > limit):
                limit = least
            if limit is not None and -top < limit:
                break
            left, right = self.kids[node]
            if left >= 0:
                for kid in (left, right):
                    if limit is None or int(bound[kid]) >= limit:
                        heapq.heappush(queue, (-int(bound[kid]), kid))
                continue
            a, b = self.first[node], self.last[node]
            scores = dot(self.x[a:b], q)
            if limit is not None and scores.dtype != object:  # these are within the exact range of doubles
                limit = max(-EXACT, min(EXACT, limit))
            at = np.arange(b - a) if limit is None else np.flatnonzero(scores >= limit)
            if len(at) > 4 * k:
                at = at[scores[at] >= np.partition(scores[at], len(at) - k - 1)[len(at) - k - 1]]
            for s, i in zip(scores[at].tolist(), self.ids[a:b][at].tolist(), strict=True):
                if i == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (int(s), -i))
                elif (int(s), -i) > best[0]:
                    heapq.heapreplace(best, (int(s), -i))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact integer product: in doubles where no sum of two can leave their exact range, else in Python's integers."""
    if not a.size or not b.size or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[-1] < EXACT // 2:
        return a @ b
    return exact(a) @ exact(b)


def exact(x: np.ndarray) -> np.ndarray:
    """Whole numbers as Python's integers."""
    out = np.empty(x.size, dtype=object)
    out[:] = [int(v) for v in x.ravel().tolist()]
    return out.reshape(x.shape)


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -most, most)


def beyond(score: int) -> bytes | None:
    """What orders the scores that a long can't tell apart, null for all others: the products of doubles have less than 2100 bits."""
    return None if LEAST_LONG < score < MOST_LONG else (score + (1 << 2111)).to_bytes(264, "big")


def _cells(axes: np.ndarray, width: float):
    k = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), batch.num_rows)
            if len(x):
                cell = np.floor(unit(x) @ axes / width).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(cell[:, i]) for i in range(k)]], names=["vec_id", "x", *[f"c{i}" for i in range(k)]])

    return run


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1, zeros as they are: for the order of vectors alone."""
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), np.finfo(np.float64).tiny)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), np.finfo(np.float64).tiny)


def _portions(scale: int, size: int):
    """Rows (shard, ids, x, lo, hi) of so many vectors each, in the order in which they come."""
    names = ["shard", "ids", "x", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, xs, held = TaskContext.get().partitionId() << 32, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, ids, xs, held
            i, x = np.concatenate(ids), np.concatenate(xs)
            own = x[:size]
            row = [[number], [i[:size].tobytes()], [packed(own)], [own.min(0).tobytes()], [own.max(0).tobytes()]]
            number, ids, xs, held = number + 1, [i[size:]], [x[size:]], max(held - size, 0)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, [pa.int64(), *[pa.binary()] * 4], strict=True)], names=names)

        for batch in batches:
            if batch.num_rows:
                ids.append(batch.column(0).to_numpy())
                xs.append(integers(matrix(batch.column(1), batch.num_rows), scale))
                held += batch.num_rows
                while held >= size:
                    yield close()
        if held:
            yield close()

    return run


def packed(x: np.ndarray) -> bytes:
    return x.astype("<i4" if np.abs(x).max(initial=0) < LARGEST else "<f8").tobytes()


def unpacked(raw: bytes, n: int, d: int) -> np.ndarray:
    kind = "<i4" if len(raw) == 4 * n * d else "<f8"
    return np.frombuffer(raw, dtype=kind).reshape(n, d).astype(np.float64)


def box_bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """At least the largest product of each query with anything in each box, errors of rounding included."""
    with np.errstate(over="ignore", invalid="ignore"):
        top = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
        top += 1 + 1e-9 * (np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T)
    return np.where(np.isnan(top), np.inf, top)


def _deal(boxes, d: int, scale: int, home: bool):
    """Queries (vec_id, x, least, home) to shards, as rows (shard, q_ids, q_x, least): to the one of the largest bound, or to the others whose bound reaches least. Least: null if unknown."""
    schema = pa.schema([("shard", pa.int64()), ("q_ids", pa.binary()), ("q_x", pa.binary()), ("least", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, lo, hi = boxes.value
        step = max(1, min(QUERIES, BOUNDS // len(shards)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                q = integers(matrix(part.column(1), part.num_rows), scale)
                ids, least = part.column(0).to_numpy(), part.column(2).to_pylist()
                bound = box_bounds(q, lo, hi)
                best = bound.argmax(1)
                if home:
                    on = np.zeros(bound.shape, dtype=bool)
                    on[np.arange(len(q)), best] = True
                else:
                    on = bound >= np.array([-np.inf if v is None else float(v) * (1 - 1e-15 * np.sign(v)) for v in least])[:, None]
                    on[np.arange(len(q)), best] = False
                for s in np.flatnonzero(on.any(0)).tolist():
                    at = np.flatnonzero(on[:, s])
                    row = [[int(shards[s])], [ids[at].tobytes()], [packed(q[at])], [[least[i] for i in at.tolist()]]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, schema.types, strict=True)], schema=schema)

    return run


def _search(k: int, d: int):
    """Rows (shard, kind, ids, x, least) sorted by (shard, kind): a shard's vectors (kind 0), then queries sent to it (kind 1)."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tree = None, None
        for batch in batches:
            for shard, kind, ids, x, least in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = np.frombuffer(ids, dtype=np.int64)
                if kind == 0:
                    own, tree = (ids, x), None  # a tree is built when the first query comes
                    continue
                if tree is None:
                    tree = KdTree(own[0], unpacked(own[1], len(own[0]), d))
                q = unpacked(x, len(ids), d)
                bounds = tree.bounds(q)
                out = [(i, v, min(max(s, LEAST_LONG), MOST_LONG), beyond(s)) for r, i in enumerate(ids.tolist()) for s, v in tree.search(q[r], i, bounds[r], k, least[r])]
                if out:
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)

    return run


def top_k(table: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows of table(vec_id, embedding) that is_query (over vec_id) picks, against all others."""
    spark = table.sparkSession
    prepare(spark)
    rows = materialize(rows_of(table), "vectors")
    each = [_of_dimension(rows.where(F.size("x") == d), is_query, d, n, k, scale) for d, n in dimensions(rows).items()]
    if not each:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = reduce(DataFrame.unionByName, each)
    return every.withColumn("rank", F.row_number().over(_best())).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best():
    return Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")  # k rows from each shard that a query went to


def _of_dimension(rows: DataFrame, is_query: Column, d: int, n: int, k: int, scale: int) -> DataFrame:
    """(query_id, vec_id, score, beyond) of n rows(vec_id, x) of dimension d: at most k of each shard for a query, the k best of all among them."""
    spark = rows.sparkSession
    found = "query_id long, vec_id long, score long, beyond binary"
    axes = principal_axes(rows.where(F.exists("x", lambda v: v != 0)), d)[:, :CELLS]
    cells = rows.mapInArrow(_cells(axes, WIDTH), "vec_id long, x array<double>, " + ", ".join(f"c{i} long" for i in range(axes.shape[1])))
    keys = [*[f"c{i}" for i in range(axes.shape[1])], "vec_id"]
    size = max(SHARD, -(-n * 16 * d // BOX_BYTES))
    in_order = cells.repartitionByRange(max(1, n // size), *keys).sortWithinPartitions(*keys).select("vec_id", "x")
    shards = materialize(in_order.mapInArrow(_portions(scale, size), "shard long, ids binary, x binary, lo binary, hi binary"), "shards")
    got = shards.select("shard", "lo", "hi").orderBy("shard").toArrow()  # at most BOX_BYTES, and a box for each partition
    table_of = lambda c: np.frombuffer(b"".join(got.column(c).to_pylist()), dtype=np.float64).reshape(-1, d)
    boxes = spark.sparkContext.broadcast((got.column("shard").to_numpy(), table_of("lo"), table_of("hi")))

    def searched(queries: DataFrame, home: bool) -> DataFrame:
        sent = queries.mapInArrow(_deal(boxes, d, scale, home), "shard long, q_ids binary, q_x binary, least array<long>")
        sent = sent.select("shard", F.lit(1).alias("kind"), F.col("q_ids").alias("ids"), F.col("q_x").alias("x"), "least")
        own = shards.select("shard", F.lit(0).alias("kind"), "ids", "x", F.lit(None).cast("array<long>").alias("least"))
        together = own.unionByName(sent).repartition(partitions(spark, 0), "shard").sortWithinPartitions("shard", "kind")
        return together.mapInArrow(_search(k, d), found)

    unknown = F.lit(None).cast("long").alias("least")
    wanted = rows.where(is_query)
    one = materialize(searched(wanted.select("vec_id", "x", unknown), True), "home")
    ranked = one.withColumn("rank", F.row_number().over(_best())).where((F.col("rank") == k) & (F.col("score") > LEAST_LONG))
    known = ranked.select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    others = searched(wanted.join(known, "vec_id", "left").select("vec_id", "x", "least"), False)
    return one.unionByName(materialize(others, "others"))
