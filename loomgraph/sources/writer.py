"""Writing graphs in the chunked layout: vertices, edges in both orders, offsets, counts and metadata.

Every chunk is one file, written by the task that holds its rows: rows are dealt out by chunk, sorted within, and each task
hands its chunks to Hadoop's file system through Spark's own writer, one folder per chunk, renamed at the end.
"""

from __future__ import annotations

from collections.abc import Iterable

import yaml
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.metadata import DST_INDEX, SRC_INDEX, VERTEX_INDEX, AdjacencyInfo, EdgeInfo, GraphInfo, PropertyGroup, VertexInfo, type_name
from loomgraph.plans.lineage import SMALL_ROWS, at_most, materialize
from loomgraph.sources import layout
from loomgraph.sources.files import Files
from loomgraph.sources.reader import OFFSET_COLUMN

ORDERS = ("src", "dst")
#: Edges up to this number are numbered by a window over each part.
WINDOW_ROWS = 5_000_000


def _write(df: DataFrame, dirs: list[str], file_type: str, to: str, sort: list[str]) -> None:
    tmp = to.rstrip("/") + ".writing"
    out = df.repartition(*dirs).sortWithinPartitions(*dirs, *sort)
    places = {d: f"_d{i}" for i, d in enumerate(dirs)}
    out = out.drop(*[s for s in sort if s.startswith("_") and s in ("_row",)])
    for d, p in places.items():
        out = out.withColumnRenamed(d, p)
    w = out.write.partitionBy(*places.values()).format(file_type).mode("overwrite")
    if file_type == "csv":
        w = w.option("header", "true").option("escape", '"').option("compression", "none").option("emptyValue", '""')
    w.save(tmp)
    Files(df.sparkSession, to).settle(tmp, to)


def vertex_spec(kind: str, df: DataFrame, groups: Iterable[Iterable[str]], chunk_size: int, file_type: str) -> VertexInfo:
    gs = tuple(PropertyGroup(file_type, "_".join(g) + "/", tuple(g), tuple(type_name(df.schema[c].dataType) for c in g)) for g in map(list, groups))
    return VertexInfo(kind, f"vertex/{kind}/", chunk_size, gs)


def write_vertices(spark: SparkSession, directory: str, v: VertexInfo, df: DataFrame) -> None:
    """df has the dense 0-based column VERTEX_INDEX and the properties of all groups."""
    n = df.count()
    chunk = F.floor(F.col(VERTEX_INDEX) / v.chunk_size).cast("int").alias("_c")
    for g in v.groups:
        _write(df.select(chunk, VERTEX_INDEX, *g.names), ["_c"], g.file_type, layout.vertex_group(directory, v, g), [VERTEX_INDEX])
    Files(spark, directory).put(layout.vertex_count(directory, v), n.to_bytes(8, "little", signed=True))


def edge_spec(triple: tuple[str, str, str], df: DataFrame, groups: Iterable[Iterable[str]], chunk_size: int, src_chunk_size: int, dst_chunk_size: int, file_type: str, orders: Iterable[str] = ORDERS) -> EdgeInfo:
    gs = tuple(PropertyGroup(file_type, "_".join(g) + "/", tuple(g), tuple(type_name(df.schema[c].dataType) for c in g)) for g in map(list, groups))
    os_ = tuple(AdjacencyInfo(o, file_type, "ordered_by_source/" if o == "src" else "ordered_by_dest/", True) for o in orders)
    return EdgeInfo(*triple, f"edge/{'_'.join(triple)}/", chunk_size, src_chunk_size, dst_chunk_size, True, os_, gs)


def write_edges(spark: SparkSession, directory: str, e: EdgeInfo, df: DataFrame, n_src: int, n_dst: int) -> None:
    """df has SRC_INDEX, DST_INDEX and the properties; parallel edges stay."""
    for o in e.orders:
        key, other = (SRC_INDEX, DST_INDEX) if o.aligned_by == "src" else (DST_INDEX, SRC_INDEX)
        n = n_src if o.aligned_by == "src" else n_dst
        size = layout.chunk_size_of(e, o)
        part = F.floor(F.col(key) / size).cast("int")
        rows = numbered(df.withColumn("_p", part), [key, other, *[c for g in e.groups for c in g.names]])
        rows = materialize(rows.withColumn("_c", F.floor(F.col("_row") / e.chunk_size).cast("int")), "edges")  # numbered once for all files
        _write(rows.select("_p", "_c", "_row", SRC_INDEX, DST_INDEX), ["_p", "_c"], o.file_type, layout.adjacency(directory, e, o), ["_row"])
        for g in e.groups:
            _write(rows.select("_p", "_c", "_row", *g.names), ["_p", "_c"], g.file_type, layout.edge_group(directory, e, o, g), ["_row"])
        # offsets: for each chunk of vertices, the row of the part where each vertex's edges begin, and the part's end
        degrees = spark.range(n).select(F.col("id").alias("v")).join(rows.groupBy(F.col(key).alias("v")).count(), "v", "left")
        degrees = degrees.select("v", F.coalesce("count", F.lit(0)).alias("n"), F.floor(F.col("v") / size).cast("int").alias("_c"))
        so_far = Window.partitionBy("_c").orderBy("v")
        upto, own, last = F.sum("n").over(so_far), F.col("v") % size, (F.col("v") % size == size - 1) | (F.col("v") == n - 1)
        place = lambda row, at: F.struct(row.alias("_row"), at.alias(OFFSET_COLUMN))
        begins = place(own, F.col("_upto") - F.col("n"))
        bounds = degrees.withColumn("_upto", upto).select("_c", F.explode(F.when(last, F.array(begins, place(own + 1, F.col("_upto")))).otherwise(F.array(begins))).alias("_b"))
        # no union of beginnings and ends: Spark 4.1 drops the shuffle behind one whose sides are dealt alike, and a chunk then lies in two tasks
        _write(bounds.select("_c", "_b.*"), ["_c"], o.file_type, layout.offsets(directory, e, o), ["_row"])
        files = Files(spark, directory)
        files.put(layout.edge_vertex_count(directory, e, o), n.to_bytes(8, "little", signed=True))
        counts = {r["_p"]: r["count"] for r in rows.groupBy("_p").count().collect()}  # one for each part folder
        for p in range(-(-n // size)):
            files.put(layout.edge_count(directory, e, o, p), counts.get(p, 0).to_bytes(8, "little", signed=True))


def numbered(df: DataFrame, order: list[str], window_rows: int = WINDOW_ROWS) -> DataFrame:
    """df(_p, ...) with _row, the number from 0 of each row among those of its part, in the order.

    A part can hold any number of edges. Beyond window_rows in all, rows are range-partitioned by part and order, numbered
    within each partition, and shifted by the count of the part's rows in the partitions before (a table of one row for each partition and part).
    """
    if at_most(df, window_rows):
        return df.withColumn("_row", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1)
    keys = ["_p", *order]
    dealt = materialize(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "numbered")
    before = dealt.groupBy("_p", "_part").count().select("_p", "_part", (F.sum("count").over(Window.partitionBy("_p").orderBy("_part")) - F.col("count")).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_p", "_part").orderBy(*order)) - 1
    return dealt.join(F.broadcast(before) if at_most(before, SMALL_ROWS) else before, ["_p", "_part"]).withColumn("_row", F.col("_base") + within).drop("_base", "_part")


def _props(groups: tuple[PropertyGroup, ...]) -> list[dict]:
    def kind(k: str) -> dict:
        return {"data_type": "list", "element_type": k[5:-1]} if k.startswith("list<") else {"data_type": k}

    return [{"file_type": g.file_type, "prefix": g.prefix, "properties": [{"name": n, "is_primary": False, "is_nullable": True, **kind(k)} for n, k in zip(g.names, g.kinds, strict=True)]} for g in groups]


def write_metadata(spark: SparkSession, g: GraphInfo) -> str:
    """The YAML files of a graph; returns the path of the graph's own."""
    files = Files(spark, g.directory)
    for v in g.vertices:
        files.put(f"{g.directory}{v.type}.vertex.yaml", yaml.safe_dump({"type": v.type, "prefix": v.prefix, "chunk_size": v.chunk_size, "property_groups": _props(v.groups), "version": "gar/v1"}).encode())
    for e in g.edges:
        spec = {"src_type": e.src, "edge_type": e.type, "dst_type": e.dst, "prefix": e.prefix, "chunk_size": e.chunk_size, "src_chunk_size": e.src_chunk_size, "dst_chunk_size": e.dst_chunk_size, "directed": e.directed, "version": "gar/v1"}
        spec |= {"adj_lists": [{"aligned_by": o.aligned_by, "file_type": o.file_type, "prefix": o.prefix, "ordered": o.ordered} for o in e.orders], "property_groups": _props(e.groups)}
        files.put(f"{g.directory}{e.table}.yaml", yaml.safe_dump(spec).encode())
    path = f"{g.directory}{g.name}.yaml"
    files.put(path, yaml.safe_dump({"name": g.name, "version": "gar/v1", "vertices": [f"{v.type}.vertex.yaml" for v in g.vertices], "edges": [f"{e.table}.yaml" for e in g.edges]}).encode())
    return path


def write_graph(
    spark: SparkSession,
    directory: str,
    name: str,
    vertices: dict[str, tuple[DataFrame, list[list[str]]]],
    edges: dict[tuple[str, str, str], tuple[DataFrame, list[list[str]]]],
    chunk_size: int = 1 << 20,
    edge_chunk_size: int = 1 << 22,
    file_type: str = "parquet",
    orders: Iterable[str] = ORDERS,
) -> str:
    """Write a graph: by vertex type and by edge triple, a table and its property groups. Returns the path of its YAML file."""
    directory = directory.rstrip("/") + "/"
    vs = [vertex_spec(k, df, groups, chunk_size, file_type) for k, (df, groups) in vertices.items()]
    for v in vs:
        write_vertices(spark, directory, v, vertices[v.type][0])
    es = [edge_spec(t, df, groups, edge_chunk_size, chunk_size, chunk_size, file_type, orders) for t, (df, groups) in edges.items()]
    for e in es:
        write_edges(spark, directory, e, edges[e.triple][0], vertices[e.src][0].count(), vertices[e.dst][0].count())
    return write_metadata(spark, GraphInfo(name, directory, tuple(vs), tuple(es)))
