"""Graphs derived from the supplied tables. Keys are dense and start at 0, so a vertex's index is its key.

next_customer: customers of consecutive orders; places: customer to order, with price and date; supplies: supplier to part, parallel
edges kept, with quantity and price; next_user: users of consecutive events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.graph import Graph
from loomgraph.metadata import DST_INDEX, SRC_INDEX, VERTEX_INDEX
from loomgraph.operators import next_edges
from loomgraph.plans.lineage import shared_dir
from loomgraph.sources.writer import write_graph

NEXT = ("Customer", "next", "Customer")
PLACES = ("Customer", "places", "Order")
SUPPLIES = ("Supplier", "supplies", "Part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def next_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_edges(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


def next_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_edges(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("o_orderdate").cast("date").alias("ordered_on")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias(SRC_INDEX), F.col("o_orderkey").alias(DST_INDEX), F.col("o_totalprice").alias("price"), date)


def supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias(SRC_INDEX), F.col("l_partkey").alias(DST_INDEX), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias(VERTEX_INDEX), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(VERTEX_INDEX), F.col("o_orderstatus").alias("status"))


_stored: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, chunk_size: int = 4096, edge_chunk_size: int = 65536) -> Graph:
    """The graph of customers and orders as chunked files in the shared folder, written once for each application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        at = f"{shared_dir(spark)}/loomgraph/graph-{spark.sparkContext.applicationId}-{len(_stored)}"
        _stored[key] = write_graph(
            spark, at, "shop",
            {"Customer": (customers(spark, sf_dir), [["name", "nation"], ["balance", "segment"]]), "Order": (orders(spark, sf_dir), [["status"]])},
            {NEXT: (next_customer(spark, sf_dir), []), PLACES: (places(spark, sf_dir), [["price"], ["ordered_on"]])},
            chunk_size, edge_chunk_size,
        )
    return Graph.load(spark, _stored[key])
