"""Streaming jobs (K): each runs over what has landed and is read back as a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import jobs
from .base import RESPONSES_SQL, as_responses, query, scratch, stream, table
from .ledger import _refresh
from .shape import _ENV_BODY, _ENV_HEAD, _ENV_TAIL
from .text import _CHUNKS_SQL, _OVERLAP, _SIZE


@query(
    "stream_envelopes",
    f"WITH {RESPONSES_SQL} SELECT {_ENV_HEAD} || {_ENV_BODY} || {_ENV_TAIL} AS line FROM r WHERE NOT skipped",
)
def stream_envelopes(spark, sf):
    base = scratch(spark, "envelopes")
    jobs.stream_envelopes(as_responses(stream(spark, sf, "events")), f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.text(f"{base}/out").withColumnRenamed("value", "line")


@query("stream_dedupe_inputs", "SELECT DISTINCT 'https://shop.example.com/u/' || user_id AS key FROM events")
def stream_dedupe_inputs(spark, sf):
    base = scratch(spark, "dedupe")
    inputs = as_responses(stream(spark, sf, "events")).selectExpr(
        "index", "concat(replace(input, 'shop.', 'SHOP.'), if(index % 2 = 0, '/', '#x')) as input", "fetched_at"
    )
    # the delay spans the table, so that no row is late and no duplicate too far from the first one
    jobs.stream_dedupe_inputs(inputs, f"{base}/out", f"{base}/cp", "input", "fetched_at", "40 days").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("key")


@query(
    "stream_progress",
    f"""WITH {RESPONSES_SQL} SELECT time_bucket(INTERVAL 6 HOUR, fetched_at) AS window_start, count(*) AS completed,
       count(*) FILTER (error IS NOT NULL AND NOT skipped) AS failed FROM r GROUP BY 1""",
)
def stream_progress(spark, sf):
    base = scratch(spark, "progress")
    jobs.stream_progress(as_responses(stream(spark, sf, "events")), f"{base}/out", f"{base}/cp", "6 hours", "1 day").awaitTermination()
    return jobs.latest_progress(spark, f"{base}/out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "stream_refresh",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, ' ' || o_custkey || ' ' AS customer,
        CASE WHEN o_custkey % 10 = 2 AND c_custkey IS NOT NULL THEN 'updated' ELSE o_orderstatus END AS status,
        CASE WHEN o_custkey % 10 IN (0, 2, 8) AND c_custkey IS NOT NULL THEN c_mktsegment ELSE '' END AS segment,
        CASE WHEN o_custkey % 10 IN (0, 2, 8) AND c_custkey IS NOT NULL THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS "geo.nation"
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def stream_refresh(spark, sf):
    base = scratch(spark, "refresh")
    orders, fresh = _refresh(spark, sf)
    # several files, one per micro-batch; the results of an input arrive in several batches, out of order
    fresh.repartition(3, "index").write.parquet(f"{base}/landed")
    landed = spark.readStream.schema(fresh.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/landed")
    jobs.stream_refresh(landed, f"{base}/results", f"{base}/cp").awaitTermination()
    return jobs.refreshed(orders, "customer", f"{base}/results", ["segment", "geo.nation"])


@query(
    "stream_changes",
    """SELECT event_id, user_id, value, lag(value) OVER w AS previous, coalesce(lag(value) OVER w <> value, false) AS changed
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def stream_changes(spark, sf):
    base = scratch(spark, "changes")
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    # three landings out of order: the last one's rows are late, between rows already seen
    for part in ("event_id % 5 = 1", "event_id % 5 > 1", "event_id % 5 = 0"):
        events.filter(part).write.mode("append").parquet(f"{base}/landed")
        landed = spark.readStream.schema(events.schema).parquet(f"{base}/landed")
        jobs.stream_changes(
            landed, f"{base}/out", f"{base}/log", f"{base}/cp", "user_id", ["ts", "event_id"], "value"
        ).awaitTermination()
    return jobs.latest_changes(spark, f"{base}/out", "user_id", ["ts", "event_id"], "value").drop("ts")


@query(
    "stream_chunks",
    f"WITH {_CHUNKS_SQL} SELECT doc_id AS url, CAST(chunk_index AS INTEGER) AS chunk_index, CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS total_chunks, content FROM k",
)
def stream_chunks(spark, sf):
    base = scratch(spark, "chunks")
    docs = stream(spark, sf, "documents").selectExpr("doc_id", "text", "timestamp_ntz'2024-05-01 12:00:00' as fetched_at")
    jobs.stream_chunks(docs, f"{base}/out", f"{base}/cp", "doc_id", "text", _SIZE, _OVERLAP, "fetched_at").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("url", "chunk_index", "total_chunks", "content")
