"""Edges from an ordered log: each row's vertex to the next row's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.metadata import DST_INDEX, SRC_INDEX
from loomgraph.plans.lineage import at_most, materialize

#: Logs of at most this many rows are ordered in one task.
ONE_TASK_ROWS = 1_000_000


def next_edges(log: DataFrame, vertex: str, order: list[str], one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """(src, dst) of rows next to each other in the order, which must be unique. Null vertices give no edge.

    Larger logs are range-partitioned by the order: rows follow each other within a partition, and the last row of
    one is followed by the first of the next partition that has any (a table of one row for each partition).
    """
    rows = log.select(F.col(vertex).cast("long").alias("_v"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    keys = [f"_o{i}" for i in range(len(order))]
    if at_most(rows, one_task_rows):
        found = rows.select(F.col("_v").alias(SRC_INDEX), F.lead("_v").over(Window.orderBy(*keys)).alias(DST_INDEX))
    else:
        dealt = materialize(rows.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()), "ordered")
        heads = dealt.groupBy("_p").agg(F.min_by("_v", F.struct(*keys)).alias("_head"))
        heads = heads.select("_p", F.lead("_head").over(Window.orderBy("_p")).alias("_after"))
        within = Window.partitionBy("_p").orderBy(*keys)
        # a default marks a partition's last row apart from one that a null vertex follows
        led = dealt.select("_p", "_v", F.lead("_v").over(within).alias("_next"), F.row_number().over(within).alias("_i"), F.count("*").over(Window.partitionBy("_p")).alias("_n"))
        joined = led.join(F.broadcast(heads), "_p")
        found = joined.select(F.col("_v").alias(SRC_INDEX), F.when(F.col("_i") == F.col("_n"), F.col("_after")).otherwise(F.col("_next")).alias(DST_INDEX))
    return found.where(F.col(SRC_INDEX).isNotNull() & F.col(DST_INDEX).isNotNull())
