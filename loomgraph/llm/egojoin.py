"""Embedding near-dedup by an epsilon grid order join.

On unit vectors a cosine of at least c is a distance of at most epsilon = sqrt(2 - 2 c). Equal vectors are joined as one, with their number. Vectors are projected on the leading
principal axes, which never lengthens a distance, and sorted by their grid cells of width epsilon there, first axis first. The sequence is cut into blocks of bounded size, these into
short intervals with tight bounding boxes. What of a block lies within epsilon of another block's box, by the boxes of its intervals, is sent there once; so vectors move in proportion
to their number and the few blocks near them, and no block moves as a whole for each of its neighbours. There the sequences are joined
recursively, halving the longer interval and skipping pairs of intervals that are provably distant, down to leaves that are compared in double precision.

A task gives link counts by vector and a star of links for each component, never all pairs, so a group of any size costs rows in proportion to its vectors times the blocks near it.

Vectors that are null, zero, or hold null or non-finite components link with nothing, others with those of their dimension: the join runs once for each dimension
that occurs. Rows without a vec_id are left out. Rows repeated under one vec_id give one row of the result: with every_row=True all their vectors count, n_links being the number of pairs of rows
of which one is the id's and the other another id's; else one vector counts, see vectors.usable. A table without rows gives none. Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import components, materialize, partitions, prepare
from loomgraph.llm.vectors import dimensions, matrix, rows_of, usable

AXES = 16
CELLS = 4  # axes in the sort key
#: Most vectors of a block, bytes of its vectors in double precision, and vectors of a leaf of the recursion and of an interval with a box of its own.
BLOCK, BLOCK_BYTES, LEAF, SHORT = 1 << 15, 16 << 20, 512, 64
#: Links of a task that are held before they are made stars.
HELD_LINKS = 1 << 20
#: What rounding may take from a squared distance, and from a product in single precision.
SLACK, SINGLE = 1e-9, 1e-4


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1. They are scaled by their largest component first, so that squares neither overflow nor vanish."""
    if not len(x):
        return x
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame, d: int) -> np.ndarray:
    """The leading axes of the covariance of all vectors(x) at length 1, as columns. Each task sends d * (d + 3) / 2 sums."""
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, outer, n = np.zeros(d), np.zeros((d, d)), 0
        for batch in batches:
            x = unit(matrix(batch.column(0), batch.num_rows))
            if len(x):
                total, outer, n = total + x.sum(0), outer + x.T @ x, n + len(x)
        values = np.concatenate([[n], total, outer[upper]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int64()), pa.array(values)], names=["i", "value"])

    got = dict(vectors.select("x").mapInArrow(run, "i long, value double").groupBy("i").agg(F.sum("value")).collect())
    n = max(got[0], 1.0)
    mean = np.array([got[1 + i] for i in range(d)]) / n
    cov = np.zeros((d, d))
    cov[upper] = np.array([got[1 + d + i] for i in range(len(upper[0]))]) / n
    cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean)
    return np.ascontiguousarray(np.linalg.eigh(cov)[1][:, ::-1][:, : min(AXES, d)])


def _cells(axes: np.ndarray, epsilon: float):
    k = min(CELLS, axes.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), batch.num_rows)
            if not len(x):
                continue
            cell = np.floor(unit(x) @ axes[:, :k] / epsilon).astype(np.int64)
            cell = np.pad(cell, ((0, 0), (0, CELLS - k)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(cell[:, i]) for i in range(CELLS)]], names=["vec_id", "m", "x", *[f"c{i}" for i in range(CELLS)]])

    return run


BLOCKS = "block long, ids binary, m binary, x binary, lo array<double>, hi array<double>, parts array<struct<lo: array<double>, hi: array<double>>>"


class Sequence:
    """Gathers vectors in order and gives them out as rows of BLOCKS of a fixed size. Vectors that single precision holds exactly are kept so."""

    def __init__(self, axes: np.ndarray, size: int, block: int):
        self.axes, self.size, self.block = axes, size, block
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, ids: np.ndarray, m: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((ids, m, x))
        self.n += len(ids)
        while self.n >= self.size:
            yield self.close()

    def close(self) -> pa.RecordBatch:
        every = [np.concatenate(c) for c in zip(*self.held, strict=True)]
        ids, m, own = (c[: self.size] for c in every)
        p = unit(own) @ self.axes
        parts = [{"lo": p[i : i + SHORT].min(0), "hi": p[i : i + SHORT].max(0)} for i in range(0, len(p), SHORT)]
        row = [[self.block], *[[raw] for raw in pack(ids, m, own)], [p.min(0)], [p.max(0)], [parts]]
        self.block, self.held, self.n = self.block + 1, [tuple(c[self.size :] for c in every)], max(self.n - self.size, 0)
        boxes = pa.list_(pa.float64())
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), boxes, boxes, pa.list_(pa.struct([("lo", boxes), ("hi", boxes)]))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds, strict=True)], names=["block", "ids", "m", "x", "lo", "hi", "parts"])


def pack(ids: np.ndarray, m: np.ndarray, x: np.ndarray) -> tuple[bytes, bytes, bytes]:
    short = x.astype(np.float32)
    return ids.tobytes(), m.tobytes(), (short if (short == x).all() else x).tobytes()


def unpack(ids: bytes, m: bytes, x: bytes, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype=np.int64)
    kind = np.float32 if len(x) == 4 * len(i) * d else np.float64
    return i, np.frombuffer(m, dtype=np.int64), np.frombuffer(x, dtype=kind).reshape(len(i), d).astype(np.float64)


def _blocks(axes: np.ndarray, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = Sequence(axes, size, TaskContext.get().partitionId() << 32)
        for batch in batches:
            if batch.num_rows:
                yield from sequence.add(batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2), batch.num_rows))
        if sequence.n:
            yield sequence.close()

    return run


def _merge_blocks(axes: np.ndarray, size: int, d: int):
    """Rows (group, block, ids, m, x) sorted by group and block: the blocks of each group laid end to end and cut anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sequence = None, None
        for batch in batches:
            for g, block, *raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if g != group:
                    if sequence is not None and sequence.n:
                        yield sequence.close()
                    group, sequence = g, Sequence(axes, size, block)
                yield from sequence.add(*unpack(*raw, d))
        if sequence is not None and sequence.n:
            yield sequence.close()

    return run


def _short(p: np.ndarray) -> np.ndarray:
    """Projections of unit vectors with the length of the rest as one more component, in single precision: products of these are no smaller than those of the vectors, but for SINGLE."""
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("nd,nd->n", p, p)))
    return np.concatenate([p, rest[:, None]], axis=1).astype(np.float32)


def interval_pairs(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, cosine: float, epsilon: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all pairs of x and y with at least the cosine, those of two leaves at a time; of one interval with itself those with i < j."""
    far = epsilon * epsilon + SLACK
    left, right = _short(px), _short(py)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and c > a and d <= a or same and a >= d:
            continue  # the mirror image
        gap = np.maximum(0, np.maximum(px[a:b].min(0) - py[c:d].max(0), py[c:d].min(0) - px[a:b].max(0)))
        if gap @ gap > far:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            # what lies off the axes adds at most the product of its lengths
            i, j = np.nonzero(left[a:b] @ right[c:d].T >= np.float32(cosine - SINGLE))
            i, j = i + a, j + c
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            if 4 * len(i) > (b - a) * (d - c):
                on = (x[a:b] @ y[c:d].T)[i - a, j - c] >= cosine
            else:
                on = np.concatenate([np.einsum("nd,nd->n", x[i[k : k + LEAF]], y[j[k : k + LEAF]]) for k in range(0, len(i), LEAF)] or [np.zeros(0)]) >= cosine
            if on.any():
                yield i[on], j[on]
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]


def join_intervals(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, cosine: float, epsilon: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """All that interval_pairs gives."""
    found = list(interval_pairs(x, y, px, py, cosine, epsilon, same))
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(side) for side in zip(*found, strict=True)) if found else (none, none)


def smallest_reachable(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each position the smallest id that links (i, j) lead to. Labels point to smaller ones and are followed each round, so long chains take few rounds."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.arange(len(ids))
    a, b = rank[i], rank[j]
    low = np.arange(len(ids))
    while True:
        before = low
        low = low.copy()
        least = np.minimum(low[a], low[b])
        for ends in (low[a], low[b], a, b):
            np.minimum.at(low, ends, least)
        low = low[low]
        if (low == before).all():
            return ids[order][low][rank]


def _join(axes: np.ndarray, d: int, cosine: float, epsilon: float, by_row: bool):
    """Rows (block, sent, ids, m, x) sorted by (block, sent): a block's own vectors come first, with sent = -1, then what other blocks send."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple | None = None
        for batch in batches:
            for _, sent, *raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids, m, x = unpack(*raw, d)
                x = unit(x)
                here = (ids, m, x, x @ axes)
                if sent < 0:
                    own = here
                yield from links(here, own, sent < 0)

    def links(a: tuple, b: tuple, same: bool) -> Iterator[pa.RecordBatch]:
        ids = a[0] if same else np.concatenate([a[0], b[0]])
        m = a[1] if same else np.concatenate([a[1], b[1]])
        shift = 0 if same else len(a[0])
        n = np.zeros(len(ids), dtype=np.int64)
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for i, j in interval_pairs(a[2], b[2], a[3], b[3], cosine, epsilon, same):
            j = j + shift
            if by_row:  # rows of one id don't link
                other = ids[i] != ids[j]
                i, j = i[other], j[other]
            np.add.at(n, i, m[j])
            np.add.at(n, j, m[i])
            ends.append((i, j))
            held += len(i)
            if held > HELD_LINKS:
                ends = [star(ends, len(ids))]
                held = len(ends[0][0])
        if not n.any():
            return
        root = smallest_reachable(*(np.concatenate(x) for x in zip(*ends, strict=True)), ids)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(n[at] * (m[at] if by_row else 1)), pa.array(root[at])], names=["vec_id", "n", "root"])

    return run


def star(ends: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between n positions that lead as far as those given: each position's to the first one that it reaches."""
    first = smallest_reachable(*(np.concatenate(x) for x in zip(*ends, strict=True)), np.arange(n))
    at = np.flatnonzero(first != np.arange(n))
    return at, first[at]


def _parts(d: int):
    """Rows (ids, m, x, to), to holding other blocks with the intervals of this one that are sent there: rows (block, sent, ids, m, x)."""
    schema = pa.schema([("block", pa.int64()), ("sent", pa.int64()), ("ids", pa.binary()), ("m", pa.binary()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *raw, to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids, m, x = unpack(*raw, d)
                for t in to or ():
                    at = np.concatenate([np.arange(k * SHORT, min((k + 1) * SHORT, len(ids))) for k in sorted(t["parts"])])
                    row = [[t["b"]], [block], *[[r] for r in pack(ids[at], m[at], x[at])]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, schema.types, strict=True)], schema=schema)

    return run


def near_duplicates(table: DataFrame, cosine: float = 0.95, every_row: bool = False) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of table(vec_id, embedding)."""
    spark = table.sparkSession
    prepare(spark)
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    every = table.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    digest = [F.xxhash64("x").alias("k1"), F.xxhash64(F.lit("x"), "x").alias("k2")]
    vectors = (rows_of(table) if every_row else usable(table)).where(F.exists("x", lambda v: v != 0)).select("vec_id", "x", *digest)
    vectors = materialize(vectors, "vectors")
    by_row = every_row and not vectors.groupBy("vec_id").count().where("count > 1").isEmpty()
    same = ["k1", "k2", *(["vec_id"] if by_row else [])]
    # equal vectors as one: the smallest id of them and their number. Rows of one id stay apart from others', with which alone they link
    classes = vectors.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    classes = materialize(classes, "classes")
    if by_row:
        distinct = vectors.dropDuplicates(same).join(classes, same).select("vec_id", "m", "x")
    else:
        distinct = vectors.join(classes.withColumnRenamed("rep", "vec_id"), ["vec_id", "k1", "k2"]).select("vec_id", "m", "x")
    distinct = materialize(distinct, "distinct")
    each = [_links(distinct.where(F.size("x") == d), d, n, cosine, epsilon, by_row) for d, n in dimensions(distinct).items()]
    linked = reduce(DataFrame.unionByName, each, spark.createDataFrame([], "vec_id long, n long, root long"))
    stars = linked.select(F.col("vec_id").alias("u"), F.col("root").alias("v"))
    counts = linked.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    if not by_row:  # a copy has the links of the first of its kind, and the other copies
        own = vectors.select("vec_id", "k1", "k2").join(classes, ["k1", "k2"])
        stars = stars.unionByName(own.where("vec_id <> rep").select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
        counts = own.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left").select("vec_id", (F.coalesce("n_links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    out = every.join(counts, "vec_id", "left").join(components(stars).withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _links(vectors: DataFrame, d: int, n: int, cosine: float, epsilon: float, by_row: bool) -> DataFrame:
    """Link counts and stars (vec_id, n, root) of n vectors(vec_id, m, x) of dimension d, m being how many rows have each."""
    spark = vectors.sparkSession
    axes = principal_axes(vectors, d)
    cells = vectors.mapInArrow(_cells(axes, epsilon), "vec_id long, m long, x array<double>, " + ", ".join(f"c{i} long" for i in range(CELLS)))
    keys = [f"c{i}" for i in range(CELLS)] + ["vec_id"]  # the id spreads a cell of very many vectors over partitions
    # blocks as large as memory allows, but some for every core
    size = max(1, min(BLOCK, BLOCK_BYTES // (8 * d), -(-n // (2 * spark.sparkContext.defaultParallelism))))
    wanted = -(-n // size)
    sequence = cells.repartitionByRange(max(1, wanted // 2), *keys).sortWithinPartitions(*keys).select("vec_id", "m", "x")
    blocks = materialize(sequence.mapInArrow(_blocks(axes, size), BLOCKS), "blocks")
    found = blocks.count()
    if found > 2 * wanted + 1:  # more partitions than it takes: neighbouring parts of blocks are laid together
        group = F.floor(F.shiftright("block", 32) / F.lit(found / wanted)).cast("long").alias("group")
        short = blocks.select(group, "block", "ids", "m", "x").repartition("group").sortWithinPartitions("group", "block")
        blocks = materialize(short.mapInArrow(_merge_blocks(axes, size, d), BLOCKS), "blocks")

    boxes = blocks.select("block", "lo", "hi")
    cell = lambda c, by=0: (F.floor(F.get(c, F.lit(0)) / epsilon) + by).cast("long")
    a = boxes.select(F.col("block").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), F.explode(F.sequence(cell("lo", -1), cell("hi", 1))).alias("cell"))
    b = boxes.select(F.col("block").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), F.explode(F.sequence(cell("lo"), cell("hi"))).alias("cell"))

    def near(lo: str, hi: str):
        gaps = F.zip_with(F.zip_with(lo, "hi_b", lambda p, q: p - q), F.zip_with("lo_b", hi, lambda p, q: p - q), lambda p, q: F.greatest(p, q, F.lit(0.0)))
        return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= epsilon * epsilon + SLACK

    # of two blocks the one that is sent to alternates
    turn = F.when(F.pmod(F.xxhash64(F.least("a", "b"), F.greatest("a", "b")), F.lit(2)) == 0, F.col("a") < F.col("b")).otherwise(F.col("a") > F.col("b"))
    pairs = materialize(a.join(b, "cell").where((F.col("a") != F.col("b")) & turn & near("lo_a", "hi_a")).select("a", "b", "lo_b", "hi_b").distinct(), "pairs")
    parts = blocks.select(F.col("block").alias("a"), F.posexplode("parts").alias("part", "box")).select("a", "part", "box.lo", "box.hi")
    to = pairs.join(parts, "a").where(near("lo", "hi")).groupBy("a", "b").agg(F.collect_list("part").alias("parts"))  # BLOCK / SHORT at most
    to = to.groupBy(F.col("a").alias("block"), F.pmod(F.xxhash64("b"), F.lit(64)).alias("_slice")).agg(F.collect_list(F.struct("b", "parts")).alias("to"))  # the blocks near one, in slices
    sent = blocks.select("block", "ids", "m", "x").join(to, "block").select("block", "ids", "m", "x", "to").mapInArrow(_parts(d), "block long, sent long, ids binary, m binary, x binary")
    own = blocks.select("block", F.lit(-1).cast("long").alias("sent"), "ids", "m", "x")
    full = own.unionByName(sent).repartition(partitions(spark, 0), "block").sortWithinPartitions("block", "sent")
    return materialize(full.mapInArrow(_join(axes, d, cosine, epsilon, by_row), "vec_id long, n long, root long"), "links")
