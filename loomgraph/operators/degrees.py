"""Degrees of all vertices, those without edges included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX


def degrees(edges: DataFrame, vertices: DataFrame | int, by: str = "src") -> DataFrame:
    """(degree, id) of vertices 0..N-1: a table with the ids as its first column, or N. Edges are counted before the shuffle."""
    key = SRC_INDEX if by == "src" else DST_INDEX
    counts = edges.groupBy(F.col(key).alias(DEGREE_ID)).agg(F.count("*").alias("_n"))
    ids = edges.sparkSession.range(vertices) if isinstance(vertices, int) else vertices
    ids = ids.select(ids[ids.columns[0]].cast("long").alias(DEGREE_ID))
    return ids.join(counts, DEGREE_ID, "left").select(F.coalesce("_n", F.lit(0)).cast("long").alias("degree"), DEGREE_ID)


def max_degree(table: DataFrame) -> DataFrame:
    """The vertex of highest degree, the smallest id on a tie: one row of a degree table. A partial maximum, no sort."""
    best = F.max_by(F.struct("degree", DEGREE_ID), F.struct(F.col("degree"), -F.col(DEGREE_ID))).alias("m")
    return table.agg(best).where("m IS NOT NULL").select("m.degree", f"m.{DEGREE_ID}")


def degree_distribution(table: DataFrame) -> DataFrame:
    """(degree, vertices): how many vertices have each degree."""
    return table.groupBy("degree").agg(F.count("*").alias("vertices"))
