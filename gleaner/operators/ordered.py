"""Order-dependent results without a single-task window.

The order is cut into ranges at boundaries drawn from a sample of the order's values, so that every range is about
equally large even if one key holds a third of all rows. A row's range is a plain expression over its own values: it is the same
whenever the row is computed again. The rows are shuffled once, by range; windows run inside a range, and
one row per range (a table as small as the number of ranges) carries totals and last rows across.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "__part"
MOST_RANGES = 512
SAMPLE = 64  # values per range that the boundaries are drawn from


def _sorted_by(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc(c) if descending else F.asc(c) for c in order]


def _place(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The order's columns in forms that survive the way through the driver."""
    return [F.unix_micros(c) if isinstance(df.schema[c].dataType, T.TimestampType) else F.col(c) for c in order]


def ranges(df: DataFrame, order: Sequence[str], descending: bool = False) -> DataFrame:
    """Add every row's range number. Boundaries come from the rows of smallest hash: a bounded sample, the same at every run."""
    wanted = min(MOST_RANGES, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = [f"k{i}" for i in range(len(order))]
    keys = df.select(*[c.alias(n) for n, c in zip(names, _place(df, order), strict=True)])
    drawn = keys.orderBy(F.xxhash64(*names)).limit(wanted * SAMPLE)
    values = drawn.agg(F.sort_array(F.collect_list(F.struct(*names))).alias("v"))
    step = F.greatest(F.floor(F.size("v") / wanted), F.lit(1)).cast("int")
    cut = values.select(F.filter("v", lambda x, i: (i > 0) & (i % step == 0)).alias("v")).first()["v"]
    if not cut:
        return df.withColumn(_PART, F.lit(0))
    typed = lambda row: F.struct(*[F.lit(row[n]).cast(keys.schema[n].dataType).alias(n) for n in names])
    bounds = F.array(*[typed(row) for row in cut])
    here = F.struct(*[c.alias(n) for n, c in zip(names, _place(df, order), strict=True)])
    # how many boundaries the row has reached, by bisection
    strides = F.array(*[F.lit(1 << i) for i in reversed(range(len(cut).bit_length()))])
    reached = F.aggregate(
        strides, F.lit(0), lambda at, s: F.when((at + s <= len(cut)) & (F.get(bounds, at + s - 1) <= here), at + s).otherwise(at)
    )
    return df.withColumn(_PART, F.lit(len(cut)) - reached if descending else reached)


def running_totals(
    df: DataFrame, order: Sequence[str], totals: Mapping[str, Column], descending: bool = False
) -> DataFrame:
    """Add inclusive running sums of the given expressions; ``order`` should be unique.

    The rows are computed three times (sample, sums per range, result) and shuffled whole once: cut the lineage of costly rows first.
    """
    parts = ranges(df.withColumns(dict(totals)), order, descending)
    sums = parts.groupBy(_PART).agg(*[F.sum(name).alias(f"__sum_{name}") for name in totals])
    # one row per range: the only window without a partition key sees nothing else
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        _PART, *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in totals]
    )
    sorting = _sorted_by(order, descending)
    within = Window.partitionBy(_PART).orderBy(*sorting).rowsBetween(Window.unboundedPreceding, 0)
    return (
        parts.withColumns({n: F.sum(n).over(within) for n in totals})
        .join(F.broadcast(offsets), _PART, "left")
        .withColumns({n: F.col(n) + F.col(f"__before_{n}") for n in totals})
        .drop(_PART, *[f"__before_{n}" for n in totals])
    )


def numbered(
    df: DataFrame, order: Sequence[str], out: str, first: int = 0, descending: bool = False
) -> DataFrame:
    """Add dense numbers in the given order, starting at ``first``."""
    counted = running_totals(df, order, {out: F.lit(1).cast("long")}, descending)
    return counted.withColumn(out, F.col(out) + (first - 1))


TOP_N = 100_000  # rows that a top-n may gather in one task


def first_n(df: DataFrame, order: Sequence[str], n: int, descending: bool = False) -> DataFrame:
    """The first ``n`` rows of an order: a top-n for a modest ``n``, else numbered rows, so that
    a large answer never passes through one task."""
    if n <= TOP_N:
        return df.orderBy(*_sorted_by(order, descending)).limit(n)
    return numbered(df, order, "__n", descending=descending).filter(F.col("__n") < n).drop("__n")


def with_previous(df: DataFrame, key: str, order: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Add the previous row's values within ``key`` (``{new column: source column}``). Computed and shuffled as ``running_totals``."""
    full = [key, *order]
    parts = ranges(df, full)
    carried = F.struct(F.col(key).alias("key"), F.struct(*[F.col(c).alias(n) for n, c in values.items()]).alias("row"))
    lasts = parts.groupBy(_PART).agg(F.max_by(carried, F.struct(*full)).alias("last"))
    # ranges may be empty, so the neighbour is the closest one that has rows
    neighbours = lasts.select(_PART, F.lag("last").over(Window.orderBy(_PART)).alias("__edge"))
    within = Window.partitionBy(_PART, key).orderBy(*order)
    first_here = F.row_number().over(within) == 1
    same_key = F.col("__edge.key") == F.col(key)
    windowed = parts.withColumn("__first", first_here).withColumns(
        {f"__lag_{name}": F.lag(source).over(within) for name, source in values.items()}
    )
    return windowed.join(F.broadcast(neighbours), _PART, "left").withColumns(
        {
            name: F.when(F.col("__first"), F.when(same_key, F.col(f"__edge.row.{name}"))).otherwise(F.col(f"__lag_{name}"))
            for name in values
        }
    ).drop(_PART, "__edge", "__first", *[f"__lag_{name}" for name in values])
