"""Overlapping text chunks for retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunk_array
from .rows import explode_rows


def chunk_records(
    df: DataFrame, url: str, text: str, size: int, overlap: int = 0, fetched_at: str | None = None
) -> DataFrame:
    """``url, chunk_index, total_chunks, content, fetched_at``: cut inside the row, no shuffle."""
    at = F.col(fetched_at) if fetched_at else F.current_timestamp()
    cut = df.select(F.col(url).alias("url"), at.alias("fetched_at"), chunk_array(F.col(text), size, overlap).alias("__c"))
    counted = cut.withColumn("total_chunks", F.size("__c"))
    rows = explode_rows(counted, ["url", "total_chunks", "fetched_at"], F.col("__c"), "content", "chunk_index")
    return rows.select("url", "chunk_index", "total_chunks", "content", "fetched_at")


def chunk_stats(df: DataFrame, text: str, size: int, overlap: int, *by: str) -> DataFrame:
    """Documents, chunks and chunk characters per group, counted without exploding the chunks."""
    chunks = chunk_array(F.col(text), size, overlap)
    counted = df.select(
        *by,
        F.size(chunks).alias("n"),
        F.aggregate(chunks, F.lit(0).cast("long"), lambda total, c: total + F.length(c)).alias("chars"),
    )
    return counted.groupBy(*by).agg(
        F.count("*").alias("documents"), F.sum("n").alias("chunks"), F.sum("chars").alias("chunk_chars")
    )
