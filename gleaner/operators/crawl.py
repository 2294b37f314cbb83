"""Walking a stored link graph: breadth-first expansion, caps, resume, request plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import truthy, wants_extraction, wants_screenshot
from ..functions.urls import normalize_crawl_url
from ..session import cut_lineage, cut_to_files
from .ordered import first_n, numbered
from .rows import spread_small

BROADCAST_URLS = 100_000  # URLs are counted before they are broadcast; beyond, the join shuffles


def _side(urls: DataFrame, count: int) -> DataFrame:
    return F.broadcast(urls) if count <= BROADCAST_URLS else urls


def _unseen(found: DataFrame, seen: DataFrame, n_seen: int) -> DataFrame:
    """The rows of ``found`` whose ``key`` is not in ``seen``, which stays in place if either side is small."""
    before = seen.select(F.col("key").alias("__key"))
    same = F.col("key").eqNullSafe(F.col("__key"))
    count = n_seen
    if n_seen > BROADCAST_URLS:
        found = cut_lineage(found)
        count = found.count()
        if count <= BROADCAST_URLS:
            before = before.join(F.broadcast(found.select("key")), same, "left_semi")  # no more than were found
    return found.join(_side(before, count), same, "left_anti")


def crawl_frontier(
    links: DataFrame,
    seeds: DataFrame,
    max_depth: int = 0,
    ranked: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """Breadth-first walk over ``links(src_url, ord, dst_url)`` from ``seeds(url)``.

    Returns ``key`` (normalised URL), ``url`` (as first found) and ``depth``, the smallest distance;
    with ``ranked`` also ``rank``, the order of discovery within a depth. Pages at
    ``max_depth`` are reached but not expanded; 0 sets no limit. ``known`` holds URLs that
    count as seen (``url``).

    The links are normalised once and written as columns, which every round reads; a link that occurs twice needs no
    pass of its own, as a round takes the smallest one per target anyway. Every round joins the new URLs only: while they
    are few (they are counted) they go to the links, which then stay in place; a larger frontier is
    a shuffle join, where the adaptive planner splits hub pages. One row per target is kept; while the URLs seen
    so far or the targets are few, these go to the others: such a round shuffles the links of its frontier and nothing else.
    A checkpoint cuts the lineage, so that neither plan nor recovery grows with the depth.
    """
    edges = cut_to_files(
        spread_small(links).select(
            normalize_crawl_url(F.col("src_url")).alias("src_key"),
            normalize_crawl_url(F.col("dst_url")).alias("key"),
            F.struct("ord", F.col("dst_url").alias("url")).alias("via"),
        )
    )
    start = (
        seeds.groupBy(normalize_crawl_url(F.col("url")).alias("key"))
        .agg(F.min("url").alias("url"))
    )
    if known is not None:
        known_keys = known.select(normalize_crawl_url(F.col("url")).alias("key")).distinct()
        start = start.join(known_keys, "key", "left_anti")

    def as_level(found: DataFrame, depth: int) -> DataFrame:
        ordered = numbered(cut_lineage(found), ["__parent", "__ord", "key"], "rank") if ranked else found.withColumn("rank", F.lit(0).cast("long"))
        return cut_lineage(ordered.select("key", "url", F.lit(depth).alias("depth"), "rank"))

    level = as_level(start.withColumns({"__parent": F.lit(0).cast("long"), "__ord": F.lit(0).cast("long")}), 0)
    size = level.count()
    levels = [level]
    seen, n_seen = level.select("key"), size
    if known is not None:
        known_keys = cut_lineage(known_keys)
        seen, n_seen = seen.unionByName(known_keys), size + known_keys.count()
    depth = 0
    while (max_depth == 0 or depth < max_depth) and size:
        depth += 1
        frontier = level.select(F.col("key").alias("src_key"), F.col("rank").alias("__parent"))
        first = F.struct("__parent", F.col("via.ord").cast("long").alias("__ord"), F.col("via.url").alias("url"))
        links_out = edges.join(_side(frontier, size), "src_key").select("key", first.alias("first"))
        found = links_out.groupBy("key").agg(F.min("first").alias("first"))
        reached = _unseen(found, seen, n_seen).select("key", "first.*")
        level = as_level(reached, depth)
        size = level.count()
        levels.append(level)
        seen, n_seen = seen.unionByName(level.select("key")), n_seen + size
    visited = reduce(DataFrame.unionByName, levels)
    return visited if ranked else visited.drop("rank")


def save_filter(visited: DataFrame, pattern: str | None, url: str = "url") -> DataFrame:
    """Pages to save; the others of the walk only contributed links."""
    return visited if not pattern else visited.filter(F.col(url).rlike(pattern))


def cap_pages(visited: DataFrame, n: int, ok: Column | None = None) -> DataFrame:
    """The first ``n`` pages in order of discovery, seeds first; 0 sets no cap.

    Failed pages (``ok`` false) do not count, so later pages fill their places.
    """
    pages = visited if ok is None else visited.filter(ok)
    return pages if n == 0 else first_n(pages, ["depth", "rank"], n)


def resume_crawl(visited: DataFrame, manifest: DataFrame) -> DataFrame:
    """Pages that an earlier run has not saved yet, with the file numbers that follow it.

    Both sides are compared in normalised form.
    """
    done = manifest.select(normalize_crawl_url(F.col("input")).alias("key")).distinct()
    fresh = cut_lineage(visited.join(done, "key", "left_anti"))
    count = manifest.agg(F.count("*").alias("__done"))
    # a one-row aggregate beside the rows, read as a scalar
    return numbered(fresh, ["depth", "rank"], "n", first=1).withColumn("n", F.col("n") + count.scalar())


def merge_manifests(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of both runs, the new one where both have the input."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    whole = F.struct(*old.columns)
    return both.groupBy("input").agg(F.max_by(whole, "__new").alias("__entry")).select("__entry.*")


# Request parameters whose response has no links, left out of a discovery request.
DISCOVERY_DROPS = (
    "screenshot", "screenshot_selector", "screenshot_full_page", "return_page_text", "json_response",
    "ai_query", "ai_selector", "ai_extract_rules", "extract_rules",
)


def needs_discovery(params: Column) -> Column:
    """The response of such a request carries no links: extraction, plain text, bare image."""
    bare_image = wants_screenshot(params) & ~truthy(params, "json_response")
    return wants_extraction(params) | truthy(params, "return_page_text") | bare_image


def discovery_request_plan(requests: DataFrame, params: str = "params", save_pattern: bool = False) -> DataFrame:
    """Requests per page: ``fetch`` where one serves both ends, else ``discovery`` without the
    link-hiding parameters, then ``save`` with all of them."""
    two_steps = F.lit(True) if save_pattern else needs_discovery(F.col(params))
    steps = F.when(two_steps, F.array(F.lit("discovery"), F.lit("save"))).otherwise(F.array(F.lit("fetch")))
    stripped = F.map_filter(params, lambda k, v: ~k.isin(*DISCOVERY_DROPS))
    planned = requests.withColumn("step", F.explode(steps))
    return planned.withColumn(params, F.when(F.col("step") == "discovery", stripped).otherwise(F.col(params)))
