"""Shaping of search results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import decode_lossy
from .inputs import dedupe_inputs
from .rows import explode_rows

# Fixed value: result key per search type.
RESULT_KEYS = {
    "classic": "organic_results",
    "news": "news_results",
    "images": "images_results",
    "shopping": "organic_results",
    "maps": "maps_results",
    "lens": "lens_results",
}
WATCH_URL = "https://www.youtube.com/watch?v="

VIDEO_FIELDS = ("link", "video_id", "title", "channel", "views", "published", "duration")


def _variant(value: Column, at: str) -> Column:
    return F.try_variant_get(value, at, "variant")


def _text(value: Column, at: str) -> Column:
    return F.coalesce(F.try_variant_get(value, at, "string"), F.lit(""))


def _is_set(value: Column) -> Column:
    """Present and not null, empty, false or zero."""
    return value.isNotNull() & ~F.to_json(value).isin("null", '""', "[]", "{}", "false", "0", "0.0")


def video_items(results: Column) -> Column:
    """Videos of a raw result list held as JSON text; null if it is no such text."""
    items = F.try_variant_get(F.try_parse_json(results), "$", "array<variant>")

    def clean(item: Column) -> Column:
        by_line = _variant(item, "$.longBylineText")
        channel = F.when(_is_set(by_line), _text(item, "$.longBylineText.runs[0].text")).otherwise(
            _text(item, "$.ownerText.runs[0].text")
        )
        id_ = F.try_variant_get(item, "$.videoId", "string")
        return F.struct(
            F.concat(F.lit(WATCH_URL), id_).alias("link"),
            id_.alias("video_id"),
            _text(item, "$.title.runs[0].text").alias("title"),
            channel.alias("channel"),
            _text(item, "$.viewCountText.simpleText").alias("views"),
            _text(item, "$.publishedTimeText.simpleText").alias("published"),
            _text(item, "$.lengthText.simpleText").alias("duration"),
        )

    return F.transform(F.filter(items, lambda i: _is_set(_variant(i, "$.videoId"))), clean)


def normalize_video_results(df: DataFrame, body: str, out: str = "body") -> DataFrame:
    """Replace ``results`` (JSON text) of video searches by a plain array; other keys stay, and a
    payload without such a text comes back unchanged. Also adds the array as ``videos``."""
    text = decode_lossy(F.col(body))
    fields = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    raw = F.try_element_at(fields, F.lit("results"))
    results = F.when(F.schema_of_variant(raw) == "STRING", F.try_variant_get(raw, "$", "string"))
    step = df.withColumn("videos", video_items(results))
    listed = F.to_variant_object("videos")
    replaced = F.to_json(F.transform_values(fields, lambda k, v: F.when(k == "results", listed).otherwise(v)))
    return step.withColumn(out, F.when(F.col("videos").isNotNull(), replaced).otherwise(text))


def result_rows(df: DataFrame, body: str, search_type: str, *keep: str) -> DataFrame:
    """One row per hit: 1-based ``position`` and the hit as JSON text."""
    hits = F.try_variant_get(
        F.try_parse_json(decode_lossy(F.col(body))), f"$.{RESULT_KEYS[search_type]}", "array<variant>"
    )
    return explode_rows(df, keep, hits, "__hit", "__at").select(
        *keep, (F.col("__at") + 1).alias("position"), F.to_json("__hit").alias("hit")
    )


def empty_results(df: DataFrame, body: str, search_type: str) -> DataFrame:
    """Classic searches whose list of results is there but empty."""
    classic = F.lower(F.coalesce(search_type, F.lit(""))).isin("classic", "")
    hits = F.try_variant_get(F.try_parse_json(decode_lossy(F.col(body))), "$.organic_results", "array<variant>")
    return df.filter(classic & (F.size(hits) == 0))


def compare_rankings(
    df: DataFrame, group: str, groups: Sequence[str], order: Sequence[Column], title: str, k: int
) -> DataFrame:
    """The first ``k`` titles of every group side by side: ``position`` and a column per group.

    The rank limit is pushed below the shuffle, so every task sends at most ``k`` rows per group.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    wanted = df.filter(F.col(group).isin(*groups))  # the others are never sorted
    top = wanted.select(group, title, rank.alias("position")).filter(F.col("position") <= k)
    # the groups are given: no pass to find the pivot's columns
    return top.groupBy("position").pivot(group, list(groups)).agg(F.first(title))


def chain_keys(found: DataFrame, key: str, index: str, details: DataFrame, detail_key: str) -> DataFrame:
    """Details of the keys found by a first search, each key looked up once."""
    keys = dedupe_inputs(found.select(F.col(key).cast("string").alias("__key"), index), "__key", index)
    return keys.join(details, F.col("__key") == F.col(detail_key).cast("string")).drop("__key")
