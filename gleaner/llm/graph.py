"""Connected components of an undirected graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for every endpoint; the component is the smallest id reachable.

    Every round gives a node the smallest label among its neighbours and then follows that label to
    the label's own (pointer jumping), so long chains shrink geometrically. Rounds end when no label
    changes. Edges with a null endpoint are ignored; an empty table gives an empty result. A hub with
    very many edges only feeds a minimum, which is combined before the shuffle, and joins whose label
    side holds one row per node, which Spark can split.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u != v")
    both = cut_lineage(pairs.unionByName(pairs.selectExpr("v as u", "u as v")).distinct())
    labels = cut_lineage(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.least("u", "v").alias("component")))
    while True:
        offered = (
            both.join(labels.select(F.col("id").alias("v"), "component"), "v")
            .groupBy("u").agg(F.min("component").alias("offer"))
        )
        lowered = labels.join(offered, labels["id"] == offered["u"], "left").select(
            "id", F.col("component").alias("was"), F.least("component", F.coalesce("offer", "component")).alias("low")
        )
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("next"))
        moved = cut_lineage(
            lowered.join(jump, "low", "left").select("id", "was", F.coalesce("next", "low").alias("component"))
        )
        changed = moved.filter("was != component").limit(1).count()
        labels = moved.select("id", "component")
        if not changed:
            return labels


HUBS = 4


def unresolved(members: DataFrame, components: DataFrame, round_no: int) -> DataFrame:
    """The buckets (``band, key``) that span several components, with each member's ``component``, whether it
    is of the bucket's largest one (``major``), and ``hubs`` drawn from that one by hash."""
    labelled = members.select("band", "key", "doc_id").join(
        components.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left"
    ).withColumn("component", F.coalesce("component", "doc_id"))
    parts = labelled.groupBy("band", "key", "component").agg(
        F.count("*").alias("n"),
        F.array(*[F.min_by("doc_id", F.xxhash64("doc_id", "band", F.lit(round_no * HUBS + i))) for i in range(HUBS)]).alias("hubs"),
    )
    top = parts.groupBy("band", "key").agg(
        F.max(F.struct("n", "component", "hubs")).alias("top"), F.count("*").alias("parts")
    ).filter("parts > 1")
    joined = labelled.join(top.select("band", "key", F.array_distinct("top.hubs").alias("hubs"), F.col("top.component").alias("major_component")), ["band", "key"])
    return joined.select("band", "key", "doc_id", "component", "hubs", (F.col("component") == F.col("major_component")).alias("major"))


def ordered_pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
