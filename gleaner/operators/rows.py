"""Rows: turning a computed array into rows, spreading few rows over all cores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keep: Sequence[str], array: Column, value: str, pos: str = "__pos") -> DataFrame:
    """The kept columns, the element's position and the element.

    For a plain ``explode`` the optimizer adds a filter on the array's size and pushes it down, which
    evaluates a costly array expression up to three times. The outer form has no such
    filter; the rows it adds for empty arrays go by their missing position.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, value)).filter(F.col(pos).isNotNull())
    return rows.drop(pos) if pos == "__pos" else rows


SMALL_SPLIT = 8 * 1024 * 1024
TASK_INPUT = 512 * 1024  # bytes of a table that one task's costly work begins with
MOST_TASKS = 10_000
FILE_SPLIT = 128 * 1024 * 1024  # a file's split, unless the session names another


def _estimate(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread_small(df: DataFrame) -> DataFrame:
    """Spread an input over all cores if it is small.

    A small file is one split, hence one core, however costly its rows are to parse. Below
    ``SMALL_SPLIT`` bytes per core the exchange is cheap and its size bounded by that very
    estimate; a large input has splits enough and is left alone.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if _estimate(df) < cores * SMALL_SPLIT else df


def _is_spread(df: DataFrame) -> bool:
    """Whether the rows come from a repartition, with nothing but projections and filters after it."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter", "Generate"):
        plan = plan.children().apply(0)
    return plan.nodeName() in ("Repartition", "RepartitionByExpression")


def spread_costly(df: DataFrame) -> DataFrame:
    """Spread rows that are costly to work on over tasks of about equal and modest length.

    The bytes of a file say little about what its rows cost once they are parsed: a few splits of the usual size would keep a
    few cores busy for hours. The number of tasks grows with the input; rows that have just been spread stay where they are.
    """
    if df.isStreaming or _is_spread(df):
        return df
    estimate = _estimate(df)
    if estimate >= MOST_TASKS * FILE_SPLIT:  # splits enough, or a size nobody knows
        return df
    return df.repartition(_costly_tasks(df, estimate))


def _costly_tasks(df: DataFrame, estimate: int) -> int:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, min(MOST_TASKS, -(-estimate // TASK_INPUT)))


def spread_in_order(df: DataFrame, *order: str) -> DataFrame:
    """Spread like ``spread_costly``, in ranges of an order: a sort after the costly work would do that work twice, the first time
    for its sample."""
    return df.repartitionByRange(_costly_tasks(df, _estimate(df)), *order)
