"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

The graph of customers and orders is written as chunked files first (reported as setup); queries then run on stored files, as a
user's would. Every query is planned and run afresh three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from loomgraph import operators as ops  # noqa: E402
from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX, VERTEX_INDEX  # noqa: E402
from loomgraph.plans import graphs  # noqa: E402

RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    g = graphs.stored(spark, sf_dir)
    setup = time.perf_counter() - began
    hub = ops.max_degree(g.degrees(graphs.NEXT)).first()[DEGREE_ID]
    far = g.two_hop_paths(graphs.NEXT, hub).agg(F.max("dst")).first()[0]
    pairs = lambda s, d: spark.range(1).select(F.lit(s).cast("long").alias("src"), F.lit(d).cast("long").alias("dst"))
    near = g.neighbors(graphs.NEXT, hub).agg(F.min(DST_INDEX)).first()[0]

    queries: dict[str, callable] = {
        "vertex_count": lambda: g.vertices("Customer", columns=["name"]).agg(F.count("*")),
        "edge_count": lambda: g.edges(*graphs.NEXT).agg(F.count("*")),
        "first_3_vertices": lambda: g.vertices("Customer").limit(3),
        "one_hop": lambda: g.neighbors(graphs.NEXT, hub).select(DST_INDEX),
        "one_hop_in": lambda: g.neighbors(graphs.NEXT, hub, "in").select(SRC_INDEX),
        "vertex_lookup": lambda: g.vertex("Customer", hub),
        "two_hop": lambda: g.two_hop(graphs.NEXT, hub),
        "one_more_hop": lambda: g.one_more_hop(graphs.NEXT, hub),
        "max_degree": lambda: ops.max_degree(g.degrees(graphs.NEXT)),
        "degree_distribution": lambda: ops.degree_distribution(g.degrees(graphs.NEXT)),
        "path_0_hops": lambda: g.bfs_exist(pairs(hub, hub)),
        "path_1_hop": lambda: g.bfs_exist(pairs(hub, near)),
        "path_2_hops": lambda: g.bfs_exist(pairs(hub, far)),
        "paths_to_all": lambda: g.bfs_length(g.vertices("Customer", columns=[]).select(F.lit(hub).cast("long").alias("src"), F.col(VERTEX_INDEX).alias("dst"))),
        "edge_property_filter": lambda: g.edges(*graphs.PLACES, columns=["price"]).where("price > 400000"),
    }

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    seconds = {}
    for name, make in queries.items():
        run(make())
        times = []
        for _ in range(RUNS):
            began = time.perf_counter()
            run(make())
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 4)
    print(json.dumps({"metric": "total_median_query_time", "value": round(sum(seconds.values()), 4), "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "setup_sec": round(setup, 2)}))


if __name__ == "__main__":
    main()
