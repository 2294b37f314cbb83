"""Vectors in Arrow tables as numpy matrices, and rows dealt over bounded blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix(table: pa.Table | pa.RecordBatch, name: str, dim: int, kind: type = np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix, one row per row."""
    column = table.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False) if len(column) else np.empty(0)
    return np.asarray(flat, kind).reshape(len(column), dim)


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def finite(embedding: str) -> Column:
    """Neither null nor with null or non-finite components."""
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(embedding).isNotNull() & good, F.lit(False))


def each_block(count: Column | str) -> Column:
    """One row for every block number below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1 if isinstance(count, str) else count - 1))


def block_counts(left: DataFrame, right: DataFrame, keys: list[str], left_rows: int, right_rows: int) -> DataFrame:
    """``keys, left_blocks, right_blocks`` of the keys on both sides: blocks of about so many rows."""
    return left.groupBy(*keys).agg(F.ceil(F.count("*") / left_rows).alias("left_blocks")).join(
        right.groupBy(*keys).agg(F.ceil(F.count("*") / right_rows).alias("right_blocks")), keys
    )


def dealt(rows: DataFrame, counts: DataFrame, keys: list[str], by: list[str], left: bool) -> DataFrame:
    """Each row in the block its hash gives, once for every block of the other side: columns ``i`` (left block) and ``j``."""
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # both sides may come from one table
    own, other, place, across = ("left_blocks", "right_blocks", "i", "j") if left else ("right_blocks", "left_blocks", "j", "i")
    return rows.join(counts, keys).withColumn(place, F.pmod(F.xxhash64(*by), own)).withColumn(across, each_block(other)).drop(own, other)
