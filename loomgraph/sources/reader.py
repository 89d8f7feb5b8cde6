"""Vertices, edges, offsets and counts as DataFrames.

A set of chunk files is one Spark scan with a declared schema: Catalyst prunes columns, pushes filters and skips row groups. Property
groups that aren't asked for are never opened. Vertex groups are joined on the vertex index. Edge groups hold no ids and are aligned by position, so
they are joined on (part, chunk, row): rows are numbered by the Parquet reader itself, for other formats as a chunk is parsed.

Where side files hold counts, the number of chunk files that they imply is compared with that of the files there, so that a missing chunk is an error and not a smaller result.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.errors import GraphBindError, GraphIOError, VertexRangeError
from loomgraph.metadata import DST_INDEX, SRC_INDEX, VERTEX_INDEX, AdjacencyInfo, EdgeInfo, GraphInfo, PropertyGroup
from loomgraph.plans.lineage import ship
from loomgraph.sources import layout
from loomgraph.sources.files import Files

#: fixed value: the column of offset files
OFFSET_COLUMN = "_graphArOffset"
_PLACE = ["_part", "_chunk", "_row"]
#: Part folders whose counts the driver reads one by one; those of more are read by a job.
FEW_PARTS = 256


def scan(spark: SparkSession, file_type: str, fields: list[T.StructField], paths: str | list[str]) -> DataFrame:
    """Chunk files of one format, with the declared columns."""
    reader = spark.read.schema(T.StructType(fields)).option("recursiveFileLookup", "true")
    if file_type == "csv":
        reader = reader.option("header", "true").option("escape", '"')
    elif file_type not in ("parquet", "orc", "json"):
        raise GraphBindError(f"Unsupported file type: {file_type}")
    try:
        return reader.format(file_type).load(paths)
    except AnalysisException as e:
        raise GraphIOError(f"Failed to read chunks from path: {paths}") from e


def _number(raw: bytes | None) -> int | None:
    return None if raw is None or len(raw) != 8 else int.from_bytes(raw, "little", signed=True)


def read_count(spark: SparkSession, path: str) -> int | None:
    """The count that a side file holds as a little-endian 64-bit integer; None where there is no such file."""
    return _number(Files(spark, path).get(path))


def edge_count(spark: SparkSession, directory: str, e: EdgeInfo) -> int | None:
    """How many edges there are by the counts beside them; None where these are missing."""
    if not e.orders:
        return None
    counts = _edge_counts(spark, directory, e, pick_order(e, None))
    return None if counts is None else sum(counts)


def _edge_counts(spark: SparkSession, directory: str, e: EdgeInfo, o: AdjacencyInfo) -> list[int] | None:
    """The number of edges of each part folder; None where a count is missing."""
    vertices = read_count(spark, layout.edge_vertex_count(directory, e, o))
    if vertices is None:
        return None
    parts = -(-vertices // layout.chunk_size_of(e, o))
    if parts <= FEW_PARTS:
        counts = [read_count(spark, layout.edge_count(directory, e, o, p)) for p in range(parts)]
    else:
        rows = spark.read.format("binaryFile").option("pathGlobFilter", f"{layout.EDGE_COUNT}*").load(layout.order_root(directory, e, o))
        counts = [_number(bytes(r[0])) for r in rows.select("content").toLocalIterator()]  # eight bytes a part
    return None if len(counts) < parts or None in counts else counts


def chunks_of_edges(spark: SparkSession, directory: str, e: EdgeInfo, o: AdjacencyInfo, vid: int | None = None) -> int | None:
    """How many chunks of edges there must be by the counts beside them, in all parts or in a vertex's; None where counts are missing."""
    if vid is not None:
        n = read_count(spark, layout.edge_count(directory, e, o, layout.part_of(e, o, vid)))
        return None if n is None else -(-n // e.chunk_size)
    counts = _edge_counts(spark, directory, e, o)
    return None if counts is None else sum(-(-n // e.chunk_size) for n in counts)


def check_chunks(spark: SparkSession, path: str, expected: int | None) -> None:
    """Raise if fewer files lie under a path than the counts say."""
    if not expected:
        return
    found = Files(spark, path).count(path) or 0
    if found < expected:
        raise GraphIOError(f"Failed to read chunks from path: {path}: {found} of {expected} are there")


def vertex_count(spark: SparkSession, g: GraphInfo, kind: str) -> int:
    v = g.vertex(kind)
    n = read_count(spark, layout.vertex_count(g.directory, v))
    if n is not None:
        return n
    if not v.groups:
        raise GraphIOError(f"No count and no properties of vertices: {kind}")
    return scan(spark, v.groups[0].file_type, [T.StructField(VERTEX_INDEX, T.LongType())], layout.vertex_group(g.directory, v, v.groups[0])).count()


def _wanted(groups: Iterable[PropertyGroup], columns: Iterable[str] | None) -> list[PropertyGroup]:
    if columns is None:
        return list(groups)
    names = {c.lower() for c in columns}
    return [g for g in groups if any(n.lower() in names for n in g.names)]


def _picked(df: DataFrame, ids: list[str], groups: Iterable[PropertyGroup], columns: Iterable[str] | None) -> DataFrame:
    names = [n for g in groups for n in g.names]
    if columns is not None:
        asked = {c.lower() for c in columns}
        known = {n.lower() for n in [*ids, *names]}
        if missing := asked - known:
            raise GraphBindError(f"No such columns: {', '.join(sorted(missing))}")
        names = [n for n in names if n.lower() in asked]
    return df.select(*ids, *[F.col(f"`{n}`") for n in names])


def read_vertices(spark: SparkSession, g: GraphInfo, kind: str, columns: Iterable[str] | None = None, vid: int | None = None) -> DataFrame:
    """(index, properties...) of a vertex type. columns: the properties to read; vid: one vertex only, from its chunk alone."""
    v = g.vertex(kind)
    if vid is not None and not 0 <= vid < vertex_count(spark, g, kind):
        raise VertexRangeError(vid)
    index = T.StructField(VERTEX_INDEX, T.LongType(), True)
    groups = _wanted(v.groups, columns)
    if not groups:
        if v.groups and read_count(spark, layout.vertex_count(g.directory, v)) is None:
            groups = [v.groups[0]]
        else:
            out = spark.range(vertex_count(spark, g, kind)).select(F.col("id").alias(VERTEX_INDEX))
            return out.where(F.col(VERTEX_INDEX) == vid) if vid is not None else out
    at = (lambda x: layout.vertex_group(g.directory, v, x)) if vid is None else (lambda x: layout.vertex_chunk(g.directory, v, x, vid))
    if vid is None and (n := read_count(spark, layout.vertex_count(g.directory, v))) is not None:
        for x in groups:
            check_chunks(spark, at(x), -(-n // v.chunk_size))
    parts = [scan(spark, x.file_type, [index, *x.fields], at(x)) for x in groups]
    if vid is not None:
        parts = [p.where(F.col(VERTEX_INDEX) == vid) for p in parts]
    return _picked(reduce(lambda a, b: a.join(b, VERTEX_INDEX), parts), [VERTEX_INDEX], groups, columns)


def _parse(file_type: str, fields: list[T.StructField]):
    """Rows of whole chunk files with their places, for formats whose readers don't number rows."""
    names = [f.name for f in fields]
    schema = pa.schema([(f.name, _arrow(f.dataType)) for f in fields])

    def table(raw: bytes) -> pa.Table:
        if file_type == "csv":
            from pyarrow import csv

            return csv.read_csv(io.BytesIO(raw), convert_options=csv.ConvertOptions(column_types=schema, include_columns=names, strings_can_be_null=True, quoted_strings_can_be_null=False))
        if file_type == "orc":
            from pyarrow import orc

            return orc.read_table(io.BytesIO(raw), columns=names)
        from pyarrow import json

        return json.read_json(io.BytesIO(raw), parse_options=json.ParseOptions(explicit_schema=schema)).select(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = table(raw).cast(schema)
                at = 0
                for b in got.to_batches(max_chunksize=50_000):
                    place = [pa.array([file] * len(b), pa.string()), pa.array(range(at, at + len(b)), pa.int64())]
                    at += len(b)
                    yield pa.RecordBatch.from_arrays([*place, *b.columns], names=["_path", "_row", *names])

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.timestamp("us", tz="UTC") if isinstance(kind, T.TimestampType) else to_arrow_type(kind)


def placed(spark: SparkSession, file_type: str, fields: list[T.StructField], paths: list[str]) -> DataFrame:
    """Chunk files with the place of each row: the numbers of its part folder (-1: none) and its chunk, from the last two parts of the file's name, and its own within the chunk."""

    def number(name: str, at: int):
        return F.coalesce(F.regexp_extract(F.element_at(F.split(F.col("_path"), "/"), at), rf"^{name}(\d+)", 1).try_cast("long"), F.lit(-1).cast("long"))

    place = [number(layout.PART, -2).alias("_part"), number(layout.CHUNK, -1).alias("_chunk"), F.col("_row")]
    names = [F.col(f"`{f.name}`") for f in fields]
    if file_type == "parquet":
        df = scan(spark, file_type, fields, paths)
        return df.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"), *names).select(*place, *names)
    try:
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    except AnalysisException as e:
        raise GraphIOError(f"Failed to read chunks from path: {paths}") from e
    ship(spark)
    own = [T.StructField("_path", T.StringType()), T.StructField("_row", T.LongType())]
    return raw.select(F.col("path"), "content").mapInArrow(_parse(file_type, fields), T.StructType([*own, *fields])).select(*place, *names)


def read_edges(spark: SparkSession, g: GraphInfo, triple: tuple[str, str, str], columns: Iterable[str] | None = None, order: str | None = None, vid: int | None = None) -> DataFrame:
    """(src, dst, properties...) of an edge type, from the copy ordered by src or dst. vid: only the edges of this vertex on that side, from its part alone."""
    return edges_at(spark, g.directory, g.edge(*triple), columns, order, vid)


def edges_at(spark: SparkSession, directory: str, e: EdgeInfo, columns: Iterable[str] | None = None, order: str | None = None, vid: int | None = None) -> DataFrame:
    o = pick_order(e, order)
    ids = [T.StructField(SRC_INDEX, T.LongType(), True), T.StructField(DST_INDEX, T.LongType(), True)]
    groups = _wanted(e.groups, columns)
    under = f"{layout.PART}{layout.part_of(e, o, vid)}/" if vid is not None else ""
    root = layout.adjacency(directory, e, o)
    expected = chunks_of_edges(spark, directory, e, o, vid)
    if expected == 0:  # no file was written
        every = [*ids, *[f for x in groups for f in x.fields]]
        return _picked(spark.createDataFrame([], T.StructType(every)), [SRC_INDEX, DST_INDEX], groups, columns)
    for at in (root, *[layout.edge_group(directory, e, o, x) for x in groups]):
        check_chunks(spark, at + under, expected)
    if not groups:
        out = scan(spark, o.file_type, ids, root + under)
    else:
        parts = [placed(spark, o.file_type, ids, [root + under])]
        for x in groups:
            at = layout.edge_group(directory, e, o, x)
            parts.append(placed(spark, x.file_type, x.fields, [at + under]))
        out = reduce(lambda a, b: a.join(b, _PLACE), parts).drop(*_PLACE)
    if vid is not None:
        out = out.where(F.col(SRC_INDEX if o.aligned_by == "src" else DST_INDEX) == vid)
    return _picked(out, [SRC_INDEX, DST_INDEX], groups, columns)


def pick_order(e: EdgeInfo, order: str | None) -> AdjacencyInfo:
    o = e.order(order) if order else e.order("src") or (e.orders[0] if e.orders else None)
    if o is None:
        raise GraphBindError(f"No adjacency list ordered by {order or 'src or dst'}: {e.table}")
    return o


def read_offset_degrees(spark: SparkSession, directory: str, e: EdgeInfo, order: str = "src") -> DataFrame | None:
    """(degree, id) of every vertex on one side, from the offset files alone: no edge is read. None where the copy or its offsets are missing.

    Offsets v and v + 1 of a chunk delimit vertex v's edges: neighbours in the order of rows within a chunk, of which each file holds one.
    """
    o = e.order(order)
    if o is None:
        return None
    n = read_count(spark, layout.edge_vertex_count(directory, e, o))
    root = layout.offsets(directory, e, o)
    if n is None or not Files(spark, root).fs.exists(Files(spark, root).path(root)):
        return None
    size = layout.chunk_size_of(e, o)
    check_chunks(spark, root, -(-n // size))
    df = placed(spark, o.file_type, [T.StructField(OFFSET_COLUMN, T.LongType())], [root]).withColumnRenamed(OFFSET_COLUMN, "begin")
    end = F.lead("begin").over(Window.partitionBy("_chunk").orderBy("_row"))  # a chunk's rows, a bounded number
    vid = (F.col("_chunk") * size + F.col("_row")).alias("vid")
    return df.withColumn("end", end).where("end IS NOT NULL").select((F.col("end") - F.col("begin")).alias("degree"), vid).where(F.col("vid") < n)
