"""Structured Streaming over edge chunks that keep arriving. The stored format itself has no streams; new chunk files are an append-only source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX

EDGES = T.StructType([T.StructField(SRC_INDEX, T.LongType()), T.StructField(DST_INDEX, T.LongType())])


def stream_edges(spark: SparkSession, path: str, file_type: str = "parquet", schema: T.StructType = EDGES) -> DataFrame:
    """Edge chunks under path, as they arrive."""
    reader = spark.readStream.schema(schema).format(file_type).option("recursiveFileLookup", "true")
    return (reader.option("header", "true") if file_type == "csv" else reader).load(path)


def running_degrees(edges: DataFrame, by: str = "src") -> DataFrame:
    """(degree, id) so far, of vertices that have edges; for update or complete mode. State is one count a vertex."""
    key = SRC_INDEX if by == "src" else DST_INDEX
    return edges.groupBy(F.col(key).alias(DEGREE_ID)).agg(F.count("*").alias("degree")).select("degree", DEGREE_ID)


def windowed_degrees(edges: DataFrame, time: str, late: str, window: str, by: str = "src") -> DataFrame:
    """(start, end, degree, id) by window of event time; edges later than the watermark are dropped and finished windows leave the state."""
    key = SRC_INDEX if by == "src" else DST_INDEX
    counted = edges.withWatermark(time, late).groupBy(F.window(time, window), F.col(key).alias(DEGREE_ID)).agg(F.count("*").alias("degree"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "degree", DEGREE_ID)
