"""Where the files of a graph lie. Pure arithmetic on names and indices."""

from __future__ import annotations

from loomgraph.metadata import AdjacencyInfo, EdgeInfo, PropertyGroup, VertexInfo

# fixed values: names of files and folders
CHUNK, PART, ADJACENCY, OFFSET, VERTEX_COUNT, EDGE_COUNT = "chunk", "part", "adj_list", "offset", "vertex_count", "edge_count"


def vertex_group(directory: str, v: VertexInfo, g: PropertyGroup) -> str:
    return f"{directory}{v.prefix}{g.prefix}"


def vertex_chunk(directory: str, v: VertexInfo, g: PropertyGroup, vid: int) -> str:
    return f"{vertex_group(directory, v, g)}{CHUNK}{vid // v.chunk_size}"


def vertex_count(directory: str, v: VertexInfo) -> str:
    return f"{directory}{v.prefix}{VERTEX_COUNT}"


def order_root(directory: str, e: EdgeInfo, o: AdjacencyInfo) -> str:
    return f"{directory}{e.prefix}{o.prefix}"


def adjacency(directory: str, e: EdgeInfo, o: AdjacencyInfo) -> str:
    return f"{order_root(directory, e, o)}{ADJACENCY}/"


def edge_group(directory: str, e: EdgeInfo, o: AdjacencyInfo, g: PropertyGroup) -> str:
    return f"{order_root(directory, e, o)}{g.prefix}"


def chunk_size_of(e: EdgeInfo, o: AdjacencyInfo) -> int:
    """Vertices of one part folder."""
    return e.src_chunk_size if o.aligned_by == "src" else e.dst_chunk_size


def part_of(e: EdgeInfo, o: AdjacencyInfo, vid: int) -> int:
    return vid // chunk_size_of(e, o)


def offsets(directory: str, e: EdgeInfo, o: AdjacencyInfo) -> str:
    return f"{order_root(directory, e, o)}{OFFSET}/"


def edge_vertex_count(directory: str, e: EdgeInfo, o: AdjacencyInfo) -> str:
    return f"{order_root(directory, e, o)}{VERTEX_COUNT}"


def edge_count(directory: str, e: EdgeInfo, o: AdjacencyInfo, part: int) -> str:
    return f"{order_root(directory, e, o)}{EDGE_COUNT}{part}"
