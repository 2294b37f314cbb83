"""Preparing input lists: deduplicate, sample, filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..functions.urls import normalize_batch_url, url_host
from .ordered import first_n


def dedupe_inputs(df: DataFrame, value: str, index: str) -> DataFrame:
    """Keep the first row (smallest ``index``) per normalised value, with all its columns.

    The minimum is combined before the shuffle, so a value repeated very often costs one
    row per task, not one row per occurrence.
    """
    whole = F.struct(*df.columns)
    return (
        df.groupBy(normalize_batch_url(F.col(value)).alias("__key"))
        .agg(F.min_by(whole, F.col(index)).alias("__first"))
        .select("__first.*")
    )


def dedupe_report(df: DataFrame, value: str) -> DataFrame:
    """One row: how many inputs, how many stay, how many go."""
    per_key = df.groupBy(normalize_batch_url(F.col(value)).alias("k")).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count("*").alias("kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
    )


def sample_exact(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all, when there are fewer), chosen by a seeded hash of the key.

    A top-n by hash: nothing is sorted as a whole. The key should be unique.
    """
    if n <= 0:
        return df
    text = F.concat_ws("\x1f", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return first_n(df.withColumn("__draw", F.md5(text)), ["__draw", *keys], n).drop("__draw")


def domain_list(df: DataFrame, url: str) -> DataFrame:
    """Distinct hosts of a URL column."""
    return df.select(url_host(F.col(url)).alias("domain")).filter(F.col("domain").isNotNull()).distinct()


def keyword_filter(df: DataFrame, text: str, alternatives: Sequence[str]) -> DataFrame:
    """Rows whose text contains one of the patterns, whatever the case."""
    return df.filter(F.col(text).rlike("(?i)" + "|".join(alternatives)))


def clean_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Strip an input column and drop what is blank."""
    stripped: Column = F.btrim(F.col(value), F.lit(WHITESPACE))
    return df.withColumn(value, stripped).filter(F.col(value) != "")
