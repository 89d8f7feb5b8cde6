"""What the operators of this subpackage share: shipping code with small Arrow batches, telling documents apart, and graph components."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.plans.lineage import discard, materialize, shared_dir, ship

__all__ = ["Documents", "components", "discard", "materialize", "partitions", "prepare", "shared_dir"]
#: Bytes of one Arrow batch: whole texts can be long, and workers share an executor's memory.
ARROW_BYTES = 4 << 20
#: Bytes that one task of a shuffle gets.
TASK_BYTES = 128 << 20
UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def prepare(spark: SparkSession) -> None:
    """Make this package importable on executors and keep Arrow batches small. Idempotent."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)i?b?\s*", str(spark.conf.get(name)).lower())
    if size is None or int(size[1]) * UNITS[size[2]] > ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def partitions(spark: SparkSession, size: int) -> int:
    """How many tasks so many bytes are dealt out to: what the session says for shuffles, or more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


@dataclass
class Documents:
    """docs(doc_id, text) under numbers that tell documents apart.

    number: the number of a document, as a column over the table `texts`(number, text, ...) has; mostly its doc_id itself. Where rows repeat an id or have none, documents are
    told apart by id and text, and numbered from 0 in the order of ids, those without one last, then of a 64-bit hash of the text: so rows that agree in both are one document.
    keys: then (number, doc_id); else None. bytes: of all texts.
    """

    texts: DataFrame
    keys: DataFrame | None
    bytes: int

    @classmethod
    def of(cls, docs: DataFrame, without_id: bool = False, keep: tuple[Column, ...] = ()) -> Documents:
        """without_id: whether rows without a doc_id count. keep: further columns of texts. One pass over ids and lengths, and, only where ids repeat, one more over the texts."""
        spark = docs.sparkSession
        rows = docs if without_id else docs.where(F.col("doc_id").isNotNull())
        rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
        by_id = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
        told = by_id.agg(F.sum("size"), F.max("n"), F.max(F.col("doc_id").isNull())).first()
        names = [c for c in rows.columns if c != "doc_id"]
        if (told[1] or 0) < 2 and not told[2]:
            # no id is null; said so, inner and outer joins of texts can share one exchange
            return cls(rows.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("number"), *names), None, int(told[0] or 0))
        rows = rows.withColumn("_text", F.xxhash64("text"))
        order = (F.col("doc_id").asc_nulls_last(), F.col("_text"))
        dealt = rows.select("doc_id", "_text").distinct().repartitionByRange(partitions(spark, 0), *order)
        dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()), "ids")
        sizes = dealt.groupBy("_part").count()  # a row for each partition
        before = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
        number = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
        keys = materialize(dealt.join(F.broadcast(before), "_part").select(number.alias("number"), "doc_id", "_text"), "numbers")
        own = keys.select("number", F.col("doc_id").alias("_id"), F.col("_text").alias("_own"))
        rows = rows.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_own")))
        return cls(rows.select("number", *names), keys.select("number", "doc_id"), int(told[0] or 0))

    def named(self, result: DataFrame, *numbers: tuple[str, str]) -> DataFrame:
        """result with doc_ids under new names in place of numbers: (column of numbers, new name)."""
        for column, name in numbers:
            if self.keys is None:
                result = result.withColumnRenamed(column, name)
            else:
                ids = self.keys.select(F.col("number").alias(column), F.col("doc_id").alias(name))
                result = result.join(ids, column, "left").drop(column)
        return result


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): one row (node, component) per node that has an edge, component its smallest node.

    Large-star and small-star rounds alternate until the edge set no longer changes. Each round takes a
    minimum per node (combined before the shuffle) and joins it back, so that no neighbour list is ever held in one task,
    and each round's edges are written to the shared folder. Only a count and a checksum reach the driver.
    Loops, repeated and null edges are ignored.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e = materialize(e, "edges")
    mark = None
    while True:  # every round that isn't the last merges something, and a path of n edges takes about log2(n) rounds
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        # large star: every larger neighbour of u points to u's smallest neighbour
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour of u, and u, point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        old, e = e, materialize(small.where("u <> v").distinct(), "edges")
        discard(old)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
