"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def rows_of(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x array<double>), one row for each row with a vec_id whose vector has only finite components."""
    x = F.col(embedding).cast("array<double>")
    bad = F.exists(x, lambda v: F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True)))
    return table.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"), bad.alias("bad")).where("vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0 AND NOT bad").drop("bad")


def usable(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x array<double>), one row per non-null vec_id whose vector has only finite components.

    Of rows repeated under one vec_id those of the usual dimension go first, that of most such rows, the smaller on a tie; of these the smallest vector counts.
    """
    rows = rows_of(table, vec_id, embedding)
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    odd = F.size("x") != F.lit(sizes["d"] if sizes else 0)
    return rows.groupBy("vec_id").agg(F.min(F.struct(odd.alias("odd"), "x")).alias("first")).select("vec_id", "first.x")


def dimensions(vectors: DataFrame) -> dict[int, int]:
    """The dimensions that at least two of vectors(x) have, with the numbers of vectors."""
    found = vectors.groupBy(F.size("x").alias("d")).count().where("count > 1").orderBy("d")
    return {r["d"]: r["count"] for r in found.collect()}


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 0))
