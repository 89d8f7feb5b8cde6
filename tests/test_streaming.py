"""Degrees of arriving edges."""

from pyspark.sql import functions as F

from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX
from loomgraph.streaming.degrees import running_degrees, stream_edges, windowed_degrees


def test_running_degrees(spark, tmp_path):
    e = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], f"{SRC_INDEX} long, {DST_INDEX} long")
    e.write.parquet(str(tmp_path / "in" / "part0"))
    q = running_degrees(stream_edges(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("deg").start()
    try:
        q.processAllAvailable()
        assert {r[DEGREE_ID]: r["degree"] for r in spark.table("deg").collect()} == {0: 2, 1: 1}
        e.write.parquet(str(tmp_path / "in" / "part1"))
        q.processAllAvailable()
        assert {r[DEGREE_ID]: r["degree"] for r in spark.table("deg").collect()} == {0: 4, 1: 2}
    finally:
        q.stop()


def test_windowed_degrees_drop_late_edges(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1, "2024-01-01 00:01:00"), (0, 2, "2024-01-01 00:02:00")], f"{SRC_INDEX} long, {DST_INDEX} long, t string").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(str(tmp_path / "w" / "a"))
    stream = stream_edges(spark, str(tmp_path / "w"), schema=rows.schema)
    q = windowed_degrees(stream, "t", "5 minutes", "10 minutes").writeStream.outputMode("append").format("memory").queryName("win").start()
    try:
        q.processAllAvailable()
        later = [(7, 1, "2024-01-01 02:00:00"), (0, 9, "2024-01-01 02:00:00")]
        spark.createDataFrame(later, f"{SRC_INDEX} long, {DST_INDEX} long, t string").withColumn("t", F.to_timestamp("t")).write.parquet(str(tmp_path / "w" / "b"))
        q.processAllAvailable()
        rows.write.parquet(str(tmp_path / "w" / "late"))
        q.processAllAvailable()
        assert [(r[DEGREE_ID], r["degree"]) for r in spark.table("win").collect()] == [(0, 2)]
    finally:
        q.stop()
