"""Graph descriptions: YAML into frozen dataclasses, and the map of types."""

from __future__ import annotations

from dataclasses import dataclass

import yaml
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from loomgraph.errors import GraphBindError, GraphIOError

# fixed values: column names of the chunked format and of the degree table
VERTEX_INDEX = "_graphArVertexIndex"
SRC_INDEX = "_graphArSrcIndex"
DST_INDEX = "_graphArDstIndex"
DEGREE_ID = "grapharId"

# fixed values: names of types in metadata
TYPES: dict[str, T.DataType] = {
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "string": T.StringType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    # beyond the minimum of the format
    "timestamp": T.TimestampType(),
    "list<int32>": T.ArrayType(T.IntegerType()),
    "list<int64>": T.ArrayType(T.LongType()),
    "list<float>": T.ArrayType(T.FloatType()),
    "list<double>": T.ArrayType(T.DoubleType()),
    "list<string>": T.ArrayType(T.StringType()),
}


def spark_type(name: str) -> T.DataType:
    if name not in TYPES:
        raise GraphBindError(f"Unsupported type: {name}")
    return TYPES[name]


def type_name(kind: T.DataType) -> str:
    """The metadata name of a Spark type."""
    for name, t in TYPES.items():
        if t == kind or isinstance(t, T.ArrayType) and isinstance(kind, T.ArrayType) and t.elementType == kind.elementType:
            return name
    raise GraphBindError(f"Unsupported type: {kind.simpleString()}")


@dataclass(frozen=True)
class PropertyGroup:
    """Columns that share a set of files. names and kinds are parallel."""

    file_type: str
    prefix: str
    names: tuple[str, ...]
    kinds: tuple[str, ...]

    @property
    def fields(self) -> list[T.StructField]:
        return [T.StructField(n, spark_type(k), True) for n, k in zip(self.names, self.kinds, strict=True)]


@dataclass(frozen=True)
class VertexInfo:
    type: str
    prefix: str
    chunk_size: int
    groups: tuple[PropertyGroup, ...]

    @property
    def table(self) -> str:
        return f"{self.type}.vertex"


@dataclass(frozen=True)
class AdjacencyInfo:
    """One physical order of an edge type's rows: aligned_by is src or dst."""

    aligned_by: str
    file_type: str
    prefix: str
    ordered: bool


@dataclass(frozen=True)
class EdgeInfo:
    src: str
    type: str
    dst: str
    prefix: str
    chunk_size: int
    src_chunk_size: int
    dst_chunk_size: int
    directed: bool
    orders: tuple[AdjacencyInfo, ...]
    groups: tuple[PropertyGroup, ...]

    @property
    def table(self) -> str:
        return f"{self.src}_{self.type}_{self.dst}.edge"

    @property
    def triple(self) -> tuple[str, str, str]:
        return self.src, self.type, self.dst

    def order(self, by: str) -> AdjacencyInfo | None:
        return next((o for o in self.orders if o.aligned_by == by), None)


@dataclass(frozen=True)
class GraphInfo:
    name: str
    directory: str
    vertices: tuple[VertexInfo, ...]
    edges: tuple[EdgeInfo, ...]

    def vertex(self, kind: str) -> VertexInfo:
        for v in self.vertices:
            if v.type == kind:
                return v
        raise GraphBindError(f"No vertices of this type: {kind}")

    def edge(self, src: str, kind: str, dst: str) -> EdgeInfo:
        for e in self.edges:
            if e.triple == (src, kind, dst):
                return e
        raise GraphBindError(f"Edges of this type are not found: {src}_{kind}_{dst}")


def _groups(found: list | None) -> tuple[PropertyGroup, ...]:
    out = []
    for g in found or ():
        props = g.get("properties") or []
        names = tuple(str(p["name"]) for p in props)
        kinds = tuple(str(p["data_type"]) if p.get("data_type") != "list" else f"list<{p['element_type']}>" for p in props)
        for k in kinds:
            spark_type(k)
        out.append(PropertyGroup(str(g.get("file_type", "parquet")), str(g.get("prefix") or "_".join(names) + "/"), names, kinds))
    return tuple(out)


def vertex_info(spec: dict) -> VertexInfo:
    try:
        kind = str(spec["type"] if "type" in spec else spec["label"])
        return VertexInfo(kind, str(spec.get("prefix") or f"vertex/{kind}/"), int(spec["chunk_size"]), _groups(spec.get("property_groups")))
    except (KeyError, TypeError) as e:
        raise GraphBindError(f"vertex metadata lacks {e}") from e


def edge_info(spec: dict) -> EdgeInfo:
    try:
        src, kind, dst = str(spec["src_type"]), str(spec["edge_type"]), str(spec["dst_type"])
        orders = tuple(
            AdjacencyInfo(str(a["aligned_by"]), str(a.get("file_type", "parquet")), str(a.get("prefix") or ("ordered_by_source/" if a["aligned_by"] == "src" else "ordered_by_dest/")), bool(a.get("ordered", True)))
            for a in spec.get("adj_lists") or ()
        )
        return EdgeInfo(src, kind, dst, str(spec.get("prefix") or f"edge/{src}_{kind}_{dst}/"), int(spec["chunk_size"]), int(spec["src_chunk_size"]), int(spec["dst_chunk_size"]), bool(spec.get("directed", True)), orders, _groups(spec.get("property_groups")))
    except (KeyError, TypeError) as e:
        raise GraphBindError(f"No edge of this type: metadata lacks {e}") from e


def read_text(spark: SparkSession, path: str) -> str:
    """A whole small file, by Spark's own file systems."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except Exception as e:
        raise GraphIOError(f"Failed to load graph info from path: {path}") from e
    if row is None:
        raise GraphIOError(f"Failed to load graph info from path: {path}")
    return row[0]


def parse(text: str, path: str) -> dict:
    try:
        spec = yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise GraphIOError(f"Failed to load graph info from path: {path}") from e
    if not isinstance(spec, dict):
        raise GraphIOError(f"Failed to load graph info from path: {path}")
    return spec


def directory_of(path: str) -> str:
    return path[: path.rfind("/") + 1]


def load_graph(spark: SparkSession, path: str) -> GraphInfo:
    """The graph that a YAML file describes, with its vertex and edge types."""
    spec = parse(read_text(spark, path), path)
    home = directory_of(path)
    directory = str(spec.get("prefix") or home)
    if not directory.endswith("/"):
        directory += "/"
    parts = lambda key: [parse(read_text(spark, home + str(p)), home + str(p)) for p in spec.get(key) or ()]
    return GraphInfo(str(spec.get("name", "")), directory, tuple(map(vertex_info, parts("vertices"))), tuple(map(edge_info, parts("edges"))))


def load_edge(spark: SparkSession, path: str) -> tuple[EdgeInfo, str]:
    """One edge type by its own YAML file, and the directory that its paths are relative to."""
    return edge_info(parse(read_text(spark, path), path)), directory_of(path)
