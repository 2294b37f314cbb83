"""The run ledger: manifests, failures, resume, refresh, cost, retries, changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.kinds import header_value, resolve_kind, route_kind
from ..functions.text import decode_lossy, strip
from ..session import cut_lineage
from .ordered import running_totals, with_previous
from .records import object_cells
from .shape import column_names

# Names of the response headers that carry cost, final URL, target status and tag.
COST_HEADER = "spb-cost"
RESOLVED_URL_HEADER = "spb-resolved-url"
TARGET_STATUS_HEADER = "spb-initial-status-code"
TAG_HEADER = "tag"


def credits_from_headers(headers: Column) -> Column:
    """Whole-number cost header; null when absent or unreadable, never an estimate."""
    return strip(header_value(headers, COST_HEADER)).try_cast("int")


def build_manifest(responses: DataFrame) -> DataFrame:
    """One entry per input with a good response: file, times, status, cost and body hash.

    Of several responses to one input the last counts; ``responses`` tells how many there
    were. Only the entry travels to the group, not the body.
    """
    kind = resolve_kind(F.col("expected_ext"), F.col("input"), F.col("body"), F.col("headers"))
    name = F.concat((F.col("index") + 1).cast("string"), F.lit("."), F.col("__kind"))
    good = responses.filter(F.col("error").isNull() & ~F.col("skipped")).withColumn("__kind", kind)
    entry = F.struct(
        F.when(route_kind(F.col("__kind")) == "", name)
        .otherwise(F.concat(route_kind(F.col("__kind")), F.lit("/"), name))
        .alias("file"),
        "fetched_at",
        F.col("status_code").alias("http_status"),
        credits_from_headers(F.col("headers")).alias("credits_used"),
        "latency_ms",
        F.sha2(F.col("body").cast("binary"), 256).alias("content_sha256"),
    )
    return (
        good.select("input", "index", entry.alias("entry"))
        .groupBy("input")
        .agg(F.max_by("entry", "index").alias("entry"), F.count("*").alias("responses"))
        .select("input", "entry.*", "responses")
    )


def carry_forward_manifest(new: DataFrame, old: DataFrame, skipped: DataFrame) -> DataFrame:
    """New entries, and the old ones of the inputs that this run skipped; new wins."""
    kept = old.join(skipped.select("input").distinct(), "input", "left_semi").select(*new.columns)
    both = new.withColumn("__new", F.lit(1)).unionByName(kept.withColumn("__new", F.lit(0)))
    return both.groupBy("input").agg(F.max_by(F.struct(*new.columns), "__new").alias("e")).select("e.*")


def failures(responses: DataFrame) -> DataFrame:
    """Failed items with their 1-based index, error, status and body text."""
    failed = responses.filter(F.col("error").isNotNull() & ~F.col("skipped"))
    return failed.select(
        (F.col("index") + 1).alias("index"), "input", "error", "status_code",
        F.coalesce(decode_lossy(F.col("body")), F.lit("")).alias("body"),
    )


def classify_status(responses: DataFrame, transparent: bool = False) -> DataFrame:
    """Status 400 and above is an error, unless statuses are passed through."""
    if transparent:
        return responses
    failed = F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))
    return responses.withColumn("error", F.coalesce("error", F.when(F.col("status_code") >= 400, failed)))


def run_summary(responses: DataFrame, run: str, command: str, started: str) -> DataFrame:
    """Per run: total, succeeded, failed; time of its first part and its command (the smallest one at equal instants)."""
    return responses.groupBy(run).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.min_by(command, F.struct(started, command)).alias("command"),
        F.min(started).alias("created_at"),
    )


def incomplete_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """Runs with fewer successes than items, the newest ``n`` first."""
    return runs.filter(F.col("succeeded") < F.col("total")).orderBy(F.desc("created_at"), "run").limit(n)


def resume_pending(inputs: DataFrame, done: DataFrame) -> DataFrame:
    """Inputs whose 1-based number has no output file yet; failed ones have none, so they return."""
    numbers = done.select((F.col("n") - 1).alias("index")).distinct()
    return inputs.join(numbers, "index", "left_anti")


def latest_results(responses: DataFrame) -> DataFrame:
    """Last good, non-empty response per input."""
    good = responses.filter(
        ~F.col("skipped") & F.col("error").isNull() & (F.octet_length(F.col("body").cast("binary")) > 0)
    )
    return good.groupBy("input").agg(F.max_by("body", "index").alias("body"))


def fresh_cells(responses: DataFrame) -> DataFrame:
    """Per input the flattened cells of its last response; null where that is no JSON object."""
    return object_cells(latest_results(responses), "body", "input")


def exact_column(name: str) -> Column:
    """A column by its whole name: flattened names hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def refresh_rows(table: DataFrame, key: str, responses: DataFrame) -> DataFrame:
    """Table rows with the cells of their fresh result as a map and a ``matched`` flag.

    The results are checkpointed before the join: read from there, both sides of the join are plain
    shuffles, which lets the adaptive planner split a key that fills much of the table.
    """
    fresh = cut_lineage(fresh_cells(responses)).withColumnsRenamed({"input": "__key", "cells": "__cells"})
    return table.join(
        fresh.withColumn("matched", F.lit(True)), strip(F.coalesce(exact_column(key), F.lit(""))) == F.col("__key"), "left"
    ).drop("__key")


def refresh_table(
    table: DataFrame, key: str, responses: DataFrame, order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Update a text table in place with the flattened fresh objects: matched cells are overwritten,
    new columns appended in first-seen order, everything else stays.

    ``columns`` names the new columns when they are known; else they are found in one pass.
    """
    rows = refresh_rows(table, key, responses)
    if columns is None:
        rows = cut_lineage(rows)
        columns = column_names(rows.filter("__cells is not null"), order, "__cells")
    cell = lambda name: F.try_element_at("__cells", F.lit(name))
    updated = [F.coalesce(cell(c), exact_column(c).cast("string")).alias(c) for c in table.columns]
    added = [F.coalesce(cell(c), F.lit("")).alias(c) for c in columns if c not in table.columns]
    return rows.select(*updated, *added)


def refresh_counts(table: DataFrame, key: str, responses: DataFrame) -> DataFrame:
    """One row: table rows with a good result (whatever its body) and failed results."""
    good = latest_results(responses).select(F.col("input").alias("__key"))
    matched = table.join(good, strip(F.coalesce(exact_column(key), F.lit(""))) == F.col("__key"), "left_semi")
    failed = responses.filter(F.col("error").isNotNull() & ~F.col("skipped"))
    both = matched.select(F.lit(1).alias("s"), F.lit(0).alias("f")).unionByName(
        failed.select(F.lit(0).alias("s"), F.lit(1).alias("f"))
    )
    return both.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("succeeded"), F.coalesce(F.sum("f"), F.lit(0)).alias("failed")
    )


# Credits per request of every command (light request, full request), and of a web
# request by proxy tier (without, with a browser).
COMMAND_CREDITS = {
    "google": (10, 15),
    "fast-search": (10, 10),
    "amazon-product": (5, 15),
    "amazon-pricing": (5, 15),
    "amazon-search": (5, 15),
    "walmart-search": (10, 15),
    "walmart-product": (10, 15),
    "youtube-search": (5, 5),
    "youtube-metadata": (5, 5),
    "chatgpt": (15, 15),
    "gemini": (15, 15),
}
WEB_CREDITS = {"default": (1, 5), "premium": (10, 25), "stealth": (75, 75)}
ESTIMATED_RANGES = {
    "google": "10-15",
    "fast-search": "10",
    "amazon-product": "5-15",
    "amazon-pricing": "5-15",
    "amazon-search": "5-15",
    "walmart-search": "10-15",
    "walmart-product": "10-15",
    "youtube-search": "5",
    "youtube-metadata": "5",
    "chatgpt": "15",
    "gemini": "15",
}


def _lookup(values: dict, key: Column) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.coalesce(key, F.lit("")))


def command_credits(command: Column, light: Column) -> Column:
    """Credits of a search command; a request is light unless it says otherwise."""
    low = _lookup({k: v[0] for k, v in COMMAND_CREDITS.items()}, command)
    high = _lookup({k: v[1] for k, v in COMMAND_CREDITS.items()}, command)
    return F.when(F.coalesce(light, F.lit(True)), low).otherwise(high)


def web_credits(tier: Column, browser: Column) -> Column:
    plain = _lookup({k: v[0] for k, v in WEB_CREDITS.items()}, tier)
    rendered = _lookup({k: v[1] for k, v in WEB_CREDITS.items()}, tier)
    return F.when(browser, rendered).otherwise(plain)


def estimate_cost(requests: DataFrame, credits: Column, *by: str) -> DataFrame:
    """Requests and their credits, per group; the tariff is an expression, not a join."""
    return requests.groupBy(*by).agg(F.count("*").alias("requests"), F.sum(credits).alias("credits"))


MIN_CREDITS = 100


def budget_check(costs: DataFrame, quota: DataFrame, credits: str = "credits") -> DataFrame:
    """One row: need, balance and verdict (``low_balance``, ``over_budget`` or ``ok``)."""
    need = costs.agg(F.coalesce(F.sum(credits), F.lit(0)).alias("need"))
    balance = quota.select(F.max("credits").alias("balance"))
    verdict = (
        F.when(F.col("balance") < MIN_CREDITS, "low_balance")
        .when(F.col("need") > F.col("balance"), "over_budget")
        .otherwise("ok")
    )
    return need.withColumn("balance", balance.scalar()).withColumn("verdict", verdict)


def progress_stats(responses: DataFrame, done_at: str, order: Sequence[str], total: int | None = None) -> DataFrame:
    """After every completion: completed, items per second, seconds to go, failure share.

    Prefix sums over range partitions, see ``ordered``: no task sees more than its share of the rows.
    """
    active = F.col("error").isNotNull() & ~F.col("skipped")
    totals = {"completed": F.lit(1).cast("long"), "failed": active.cast("long")}
    # aggregates of the partitioned rows, read as scalars
    facts = responses.agg(F.min(done_at).alias("t0"), F.count("*").alias("n"))
    rows = running_totals(responses, order, totals)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    elapsed = (micros(F.col(done_at)) - micros(F.col("__t0"))) / F.lit(1_000_000.0)
    rate = F.when(F.col("elapsed") > 0, F.col("completed") / F.col("elapsed"))
    left = (F.lit(total) if total is not None else F.col("__n")) - F.col("completed")
    return (
        rows.withColumn("__t0", facts.select("t0").scalar())
        .withColumn("__n", facts.select("n").scalar())
        .withColumn("elapsed", elapsed)
        .withColumn("per_second", rate)
        .withColumn("eta_seconds", F.when((F.col("per_second") > 0) & (left > 0), left / F.col("per_second")))
        .withColumn("failure_pct", F.when(F.col("failed") > 0, F.col("failed") / F.col("completed") * 100))
        .drop("__t0", "__n")
    )


def eta_text(seconds: Column) -> Column:
    """Duration as text: ``45s``, ``3m 10s``, ``2h 5m``."""
    s = F.floor(seconds)
    m, h = F.floor(s / 60), F.floor(s / 3600)
    with_rest = lambda big, unit, rest, small: F.concat(
        big.cast("string"), F.lit(unit), F.when(rest > 0, F.concat(F.lit(" "), rest.cast("string"), F.lit(small))).otherwise(F.lit(""))
    )
    return (
        F.when(seconds < 0, "—")
        .when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(m < 60, with_rest(m, "m", s % 60, "s"))
        .otherwise(with_rest(h, "h", m % 60, "m"))
    )


def final_attempt(attempts: DataFrame, key: str = "input") -> DataFrame:
    """The attempt a retry loop ends with: the first with a status below 500, else the last."""
    row = F.struct(*attempts.columns)
    good = F.col("status_code") < 500
    return (
        attempts.groupBy(key)
        .agg(
            F.coalesce(
                F.min_by(F.when(good, row), F.when(good, F.col("attempt"))), F.max_by(row, "attempt")
            ).alias("__row")
        )
        .select("__row.*")
    )


# Proxy tiers in the order in which blocking escalates them, and blocking statuses.
TIERS = ("default", "premium", "stealth")
BLOCKED = (403, 429)


def escalation_outcome(attempts: DataFrame, key: str = "input") -> DataFrame:
    """The attempt an escalation ends with: the first tier that is not blocked, else the last."""
    rank = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("tier"))
    blocked = F.coalesce(F.col("target_status").isin(*BLOCKED), F.lit(False))
    # unblocked before blocked; then upwards among the unblocked, downwards among the blocked
    preference = F.struct(blocked, F.when(blocked, -rank).otherwise(rank))
    row = F.struct(*attempts.columns, blocked.alias("blocked"))
    return attempts.groupBy(key).agg(F.min_by(row, preference).alias("__row")).select("__row.*")


def content_changes(before: DataFrame, after: DataFrame, key: str, body: str) -> DataFrame:
    """Per key: ``new``, ``gone``, ``changed`` or ``unchanged``, by body hash.

    Hashes, not bodies, are shuffled; one aggregation over both snapshots replaces the join.
    """

    def hashed(df: DataFrame, side: str) -> DataFrame:
        sha = F.sha2(F.col(body).cast("binary"), 256)
        return df.select(key, *[(sha if s == side else F.lit(None).cast("string")).alias(s) for s in ("before", "after")])

    both = hashed(before, "before").unionByName(hashed(after, "after"))
    state = (
        F.when(F.col("before").isNull(), "new")
        .when(F.col("after").isNull(), "gone")
        .when(F.col("before") != F.col("after"), "changed")
        .otherwise("unchanged")
    )
    grouped = both.groupBy(key).agg(F.max("before").alias("before"), F.max("after").alias("after"))
    return grouped.withColumn("state", state)


def value_changes(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Every observation with the previous value of its item and whether it changed."""
    rows = with_previous(df, key, order, {"previous": value})
    return rows.withColumn("changed", F.coalesce(F.col("previous") != F.col(value), F.lit(False)))


def duplicate_content(df: DataFrame, key: str, body: str) -> DataFrame:
    """Bodies that several inputs share: hash, number of copies, first and last input.

    The members are not gathered in a list: a group may hold a third of all rows.
    """
    sha = F.sha2(F.col(body).cast("binary"), 256)
    return (
        df.select(sha.alias("content_sha256"), key)
        .groupBy("content_sha256")
        .agg(F.count("*").alias("copies"), F.min(key).alias("first"), F.max(key).alias("last"))
        .filter(F.col("copies") > 1)
    )


def latency_report(responses: DataFrame, *by: str) -> DataFrame:
    """Per group: items, failures, smallest, median, 95th percentile and largest latency.

    The percentiles are exact: the smallest latency that the given share of the items does not exceed. They
    come from a count per latency, so what is ordered grows with the different latencies, not the items.
    """
    counts = cut_lineage(responses.groupBy(*by, "latency_ms").agg(
        F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("failed")
    ))
    known = F.when(F.col("latency_ms").isNotNull(), F.col("n")).otherwise(F.lit(0).cast("long"))
    # running totals over ranges of (group, latency): neither a group nor the table without groups meets in one task
    placed = running_totals(counts, [*by, "latency_ms"], {"__upto": known})
    if by:
        # what stands before a group in the order is the smallest running total in it
        starts = placed.groupBy(*by).agg(F.min(F.col("__upto") - known).alias("__start"), F.sum(known).alias("__all"))
        starts = cut_lineage(starts.withColumnsRenamed({c: f"__of_{c}" for c in by}))  # a row per group
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in by])
        inside = placed.join(starts, same).drop(*[f"__of_{c}" for c in by])
    else:
        inside = placed.withColumn("__start", F.lit(0).cast("long")).withColumn("__all", counts.agg(F.sum(known)).scalar())
    upto = F.col("__upto") - F.col("__start")
    at = lambda p: F.min(F.when(upto >= F.col("__all") * p, F.col("latency_ms")))
    return inside.groupBy(*by).agg(
        F.sum("n").alias("items"),
        F.sum("failed").alias("failed"),
        F.min("latency_ms").alias("min_ms"),
        at(0.5).alias("p50_ms"),
        at(0.95).alias("p95_ms"),
        F.max("latency_ms").alias("max_ms"),
    )


def header_summary(responses: DataFrame, headers: str = "headers", command: str | None = None, *keep: str) -> DataFrame:
    """Cost, final URL, target status and tag of every response; without a cost header
    the command's usual range."""
    h = F.col(headers)
    estimate = _lookup(ESTIMATED_RANGES, F.col(command)) if command else F.lit(None).cast("string")
    cost = header_value(h, COST_HEADER)
    return responses.select(
        *keep,
        cost.alias("credit_cost"),
        F.when(cost.isNull(), estimate).alias("estimated_cost"),
        header_value(h, RESOLVED_URL_HEADER).alias("resolved_url"),
        header_value(h, TARGET_STATUS_HEADER).alias("target_status"),
        header_value(h, TAG_HEADER).alias("tag"),
    )
