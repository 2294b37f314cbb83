"""Sitemaps: page URLs, and indexes that name further sitemaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import decode_lossy, strip
from ..operators.rows import explode_rows
from ..session import cut_lineage

INDEX_LEVELS = 2  # fixed value: how far indexes are followed by default
_ENTRY = "ARRAY<STRUCT<loc: ARRAY<STRING>>>"
_OPTIONS = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "broken"}


def _locations(entries: str) -> Column:
    found = F.flatten(F.transform(F.col(entries), lambda e: F.coalesce(e["loc"], F.array().cast("array<string>"))))
    return F.filter(F.transform(found, strip), lambda u: u.isNotNull() & (u != ""))


def parse_sitemaps(df: DataFrame, url: str, body: str) -> DataFrame:
    """Per sitemap: ``urls`` of pages and ``children`` (further sitemaps), in order.

    The schema of the sitemap protocol is fixed, so Spark's own XML reader takes the payload, with or without
    the protocol's namespace; malformed text gives null lists.
    """
    schema = f"url {_ENTRY}, sitemap {_ENTRY}, broken STRING"
    read = df.select(F.col(url), F.from_xml(decode_lossy(F.col(body)), schema, _OPTIONS).alias("x"))
    whole = read.filter("x.broken is null").select(
        F.col(url).alias("__at"), F.col("x.url").alias("__pages"), F.col("x.sitemap").alias("__maps")
    )
    empty = F.array().cast("array<string>")
    return whole.select(
        F.col("__at").alias(url),
        F.coalesce(_locations("__pages"), empty).alias("urls"),
        F.coalesce(_locations("__maps"), empty).alias("children"),
    )


def sitemap_urls(df: DataFrame, url: str, body: str) -> DataFrame:
    """Page URLs of plain sitemaps, with their ordinal."""
    plain = F.when(F.size("children") == 0, F.col("urls"))
    return explode_rows(parse_sitemaps(df, url, body), [url], plain, "page_url", "ord")


def sitemap_index_expand(
    stored: DataFrame, seeds: DataFrame, url: str = "url", body: str = "body", levels: int = INDEX_LEVELS
) -> DataFrame:
    """Page URLs reached from the seed sitemaps, following indexes through ``levels`` further levels:
    ``seed, depth, page_url``.

    ``stored`` holds the fetched sitemaps, one per URL (of several the one with the smallest body counts). A sitemap
    that several indexes of a level name is read once per seed. One parse serves all levels, and
    a level is written before the next one is joined to it.
    """
    once = stored.groupBy(url).agg(F.min(body).alias(body))
    parsed = cut_lineage(parse_sitemaps(once, url, body))
    supported = F.col(url).startswith("http://") | F.col(url).startswith("https://")
    level = seeds.select(F.col(url).alias("seed"), url).filter(supported).distinct()
    pages = []
    for depth in range(levels + 1):
        here = cut_lineage(level.join(parsed, url))
        pages.append(
            here.filter(F.size("children") == 0).select(
                "seed", F.lit(depth).alias("depth"), F.explode("urls").alias("page_url")
            )
        )
        level = here.select("seed", F.explode("children").alias(url)).filter(supported).distinct()
    return reduce(DataFrame.unionByName, pages)
