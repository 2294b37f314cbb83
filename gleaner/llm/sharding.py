"""Shards on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class RingParams:
    """``slack`` 0 fills every shard to the same number of rows, at most one apart; a positive one lets a
    shard take up to ``1 + slack`` times the mean, which moves fewer rows when shards change.
    ``buckets`` splits the ring's keys within each arc, so that an arc's rows are numbered by several tasks;
    ``virtual_nodes`` and ``buckets`` together bound what reaches the driver."""

    shards: int = 40
    virtual_nodes: int = 64
    slack: float = 0.0
    buckets: int = 4
    seed: int = 17


RING = 1 << 16  # places on the ring


def virtual_nodes(params: RingParams) -> list[tuple[int, int]]:
    """``(place, shard)`` clockwise. A shard's places depend on its own number only."""
    out = []
    for shard in range(params.shards):
        for copy in range(params.virtual_nodes):
            digest = hashlib.md5(f"{params.seed}/{shard}/{copy}".encode()).digest()
            out.append((int.from_bytes(digest[:8], "big") % RING, shard))
    return sorted(out)


def arc_of_places(nodes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``(place, arc)`` for every place: the first virtual node at or after it, clockwise."""
    out, node = [], 0
    for place in range(RING):
        while node < len(nodes) and nodes[node][0] < place:
            node += 1
        out.append((place, node % len(nodes)))
    return out


def capacities(rows: int, params: RingParams) -> list[int]:
    if params.slack > 0:
        return [-int(-rows * (1 + params.slack) // params.shards)] * params.shards
    low, more = divmod(rows, params.shards)
    return [low + (shard < more) for shard in range(params.shards)]


def walk(arcs: dict[int, int], nodes: list[tuple[int, int]], params: RingParams) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of every arc go: ``(arc, from, to, shard, slot of the first)``.

    ``arcs`` maps an arc (the number of the virtual node that ends it) to its count of keys. Every arc's
    keys first fill the shard of that node; what finds no room continues clockwise to the next node whose shard
    has some. First every arc takes what its own shard can hold, in ring order, then the overflow
    travels on, so that only keys of full shards move.
    """
    room = capacities(sum(arcs.values()), params)
    filled = [0] * params.shards
    out, over = [], []

    def put(arc: int, first: int, count: int, shard: int) -> int:
        taken = min(count, room[shard] - filled[shard])
        if taken > 0:
            out.append((arc, first, first + taken, shard, filled[shard]))
            filled[shard] += taken
        return max(taken, 0)

    for arc in sorted(arcs):
        taken = put(arc, 0, arcs[arc], nodes[arc][1])
        if taken < arcs[arc]:
            over.append((arc, taken, arcs[arc] - taken))
    for arc, first, count in over:
        step = 1
        while count:
            taken = put(arc, first, count, nodes[(arc + step) % len(nodes)][1])
            first, count, step = first + taken, count - taken, step + 1
    return out


def shard(docs: DataFrame, params: RingParams = RingParams(), ties: Sequence[str] = ("text",)) -> DataFrame:
    """The rows of ``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 within the shard).

    A row's key is its doc_id; it lies on the ring at the md5 of seed and key and belongs to the next virtual node
    clockwise. Shards have a bounded load: keys that find theirs full continue clockwise. Which keys of an
    arc stay is decided by the md5, ties by the columns ``ties`` (those there are), so that a row gets the same place however the
    table is partitioned; rows equal in all of these are interchangeable.

    Only counts leave the tasks: one per arc and bucket, ``shards * virtual_nodes * buckets`` at
    most, from which the walk around the ring decides ranges of ranks. Rows are ranked within their arc and
    bucket, which spreads them over as many groups. A null doc_id is a key of its own. An empty table
    gives an empty result. Existing columns ``shard`` and ``slot`` are replaced; others pass through.
    """
    spark = docs.sparkSession
    kept = docs.drop("shard", "slot")
    nodes = virtual_nodes(params)
    arcs_at = F.broadcast(spark.createDataFrame(arc_of_places(nodes), "__place int, __arc int"))  # RING rows
    hashed = F.md5(F.concat_ws("/", F.lit(f"{params.seed}"), F.lit("key"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    place = F.conv(F.substring("__h", 1, 4), 16, 10).cast("int")
    keyed = (
        kept.withColumn("__h", hashed).withColumn("__place", place)
        .join(arcs_at, "__place")
        .withColumn("__bucket", F.conv(F.substring("__h", 9, 6), 16, 10).cast("int") % params.buckets)
    )
    counts = keyed.groupBy("__arc", "__bucket").count().collect()  # bounded by the ring, not by the rows
    sizes: dict[tuple[int, int], int] = {(r["__arc"], r["__bucket"]): r["count"] for r in counts}
    arcs: dict[int, int] = {}
    starts: dict[tuple[int, int], int] = {}
    for arc, bucket in sorted(sizes):
        starts[arc, bucket] = arcs.get(arc, 0)
        arcs[arc] = arcs.get(arc, 0) + sizes[arc, bucket]
    pieces = []
    for arc, first, last, to, slot in walk(arcs, nodes, params):
        for bucket in range(params.buckets):
            begin = starts.get((arc, bucket))
            if begin is None:
                continue
            low, high = max(first, begin), min(last, begin + sizes[arc, bucket])
            if low < high:  # ranks within the bucket, and the slot of rank 0
                pieces.append((arc, bucket, low - begin, high - begin, to, slot + begin - first))
    table = spark.createDataFrame(pieces, "__arc int, __bucket int, __from long, __to long, shard int, __slot long")
    further = [F.coalesce(F.md5(F.col(c).cast("string")), F.lit("")) for c in ties if c in kept.columns]
    rank = F.row_number().over(Window.partitionBy("__arc", "__bucket").orderBy("__h", *further)).cast("long") - 1
    ranked = keyed.withColumn("__rank", rank)
    routes = F.broadcast(table.groupBy("__arc", "__bucket").agg(F.array_sort(F.collect_list(F.struct("__from", "__to", "shard", "__slot"))).alias("__routes")))
    found = F.filter("__routes", lambda r: (r["__from"] <= F.col("__rank")) & (F.col("__rank") < r["__to"]))[0]
    return (
        ranked.join(routes, ["__arc", "__bucket"]).withColumn("__route", found)
        .select(*kept.columns, F.col("__route.shard").alias("shard"), (F.col("__route.__slot") + F.col("__rank")).alias("slot"))
    )
