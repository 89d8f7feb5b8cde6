"""Cutting lineage, checking sizes, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.errors import GraphIOError

#: Used only where the session names no shared folder, as in tests.
FALLBACK_DIR = "/tmp/checkpoints/loomgraph"
#: Rows up to which a side of a join is broadcast: edges of two 8-byte ids, 16 MB and a few times that as a hash table.
SMALL_ROWS = 1_000_000


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors, for functions that run in Python there. Once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_loomgraph_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="loomgraph")) / "loomgraph.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(str(target))
    sc._loomgraph_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it. Without that setting a local session gets one, a cluster's is refused: executors wouldn't see each other's files."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise GraphIOError("spark.checkpoint.dir isn't set: tables between stages need a folder that all executors share")
        given = FALLBACK_DIR
        os.makedirs(given, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", given)
    return given.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df once as a table in the shared folder and read it back. The table is deleted when the driver ends, if not before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomgraph/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._loomgraph_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing will read any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._loomgraph_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df with a broadcast hint if it is counted to be small; else as it is, for a shuffled join."""
    return F.broadcast(df) if at_most(df, rows) else df
