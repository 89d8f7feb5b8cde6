"""Table functions for SQL over attached views. Their bodies are plain SELECTs, which the optimizer inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX

_PAIR = f"TABLE({SRC_INDEX} BIGINT, {DST_INDEX} BIGINT)"


def register_tables(spark: SparkSession, edge_view: str, degree_view: str) -> None:
    """edges_vertex(), two_hop(vid), two_hop_paths(vid) and one_more_hop(vid) over a view of edges and one of degrees (names without quotes)."""
    e = f"`{edge_view}`"
    pick = f"SELECT {SRC_INDEX}, {DST_INDEX} FROM {e}"
    around = f"(SELECT DISTINCT {SRC_INDEX} AS v, {DST_INDEX} AS n FROM {e})"
    bodies = {
        f"edges_vertex() RETURNS TABLE(degree BIGINT, {DEGREE_ID} BIGINT)": f"SELECT degree, {DEGREE_ID} FROM `{degree_view}`",
        f"two_hop(vid BIGINT) RETURNS {_PAIR}": f"{pick} WHERE {SRC_INDEX} = vid UNION ALL SELECT b.{SRC_INDEX}, b.{DST_INDEX} FROM {e} a JOIN {e} b ON a.{DST_INDEX} = b.{SRC_INDEX} WHERE a.{SRC_INDEX} = vid",
        "two_hop_paths(vid BIGINT) RETURNS TABLE(src BIGINT, mid BIGINT, dst BIGINT)": f"SELECT a.{SRC_INDEX}, a.{DST_INDEX}, b.{DST_INDEX} FROM {e} a JOIN {e} b ON a.{DST_INDEX} = b.{SRC_INDEX} WHERE a.{SRC_INDEX} = vid",
        f"one_more_hop(vid BIGINT) RETURNS {_PAIR}": f"{pick} WHERE {SRC_INDEX} = vid UNION ALL SELECT c.{SRC_INDEX}, c.{DST_INDEX} FROM {around} a JOIN {e} c ON c.{SRC_INDEX} = a.n JOIN {around} b ON b.n = c.{DST_INDEX} AND b.v = a.v WHERE a.v = vid",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
