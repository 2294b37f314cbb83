"""Structured Streaming forms of the ledger, export and chunk operators.

Every job takes a streaming DataFrame over landed files and runs what has arrived, then stops
(``availableNow``); run it again, or on a schedule, to go on from its checkpoint. Results that
change later are appended, one folder per micro-batch, so that a replayed batch overwrites its own folder
and nothing else; reading them back takes the last word per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.urls import normalize_batch_url
from ..operators.chunks import chunk_records
from ..operators.ledger import refresh_table
from ..operators.ordered import with_previous
from ..operators.shape import result_envelope
from ..session import cut_lineage


def _run(stream: DataFrame, checkpoint: str, format: str, path: str) -> StreamingQuery:
    writer = stream.writeStream.format(format).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(availableNow=True).start(path)


def stream_envelopes(responses: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Result lines of the responses that arrive, appended as text files."""
    return _run(result_envelope(responses).select("line"), checkpoint, "text", path)


def stream_chunks(
    documents: DataFrame, path: str, checkpoint: str, url: str, text: str, size: int, overlap: int, fetched_at: str
) -> StreamingQuery:
    """Chunk records of the texts that arrive: stateless."""
    return _run(chunk_records(documents, url, text, size, overlap, fetched_at), checkpoint, "parquet", path)


def dedupe_stream(inputs: DataFrame, value: str, event_time: str, delay: str) -> DataFrame:
    """First arrival per normalised input, duplicates within ``delay`` dropped; adds ``key``."""
    keyed = inputs.withColumn("key", normalize_batch_url(F.col(value)))
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["key"])


def stream_dedupe_inputs(
    inputs: DataFrame, path: str, checkpoint: str, value: str, event_time: str, delay: str
) -> StreamingQuery:
    return _run(dedupe_stream(inputs, value, event_time, delay), checkpoint, "parquet", path)


def _version(path: str, batch: int) -> str:
    return f"{path}/batch={batch}"


def progress_stream(responses: DataFrame, every: str, delay: str) -> DataFrame:
    """Completions and failures per time window."""
    return (
        responses.withWatermark("fetched_at", delay)
        .groupBy(F.window("fetched_at", every).alias("w"))
        .agg(
            F.count("*").alias("completed"),
            F.count_if(F.col("error").isNotNull() & ~F.col("skipped")).alias("failed"),
        )
        .select(F.col("w.start").alias("window_start"), "completed", "failed")
    )


def stream_progress(responses: DataFrame, path: str, checkpoint: str, every: str, delay: str) -> StreamingQuery:
    """Counters per window, updated as responses arrive; see ``latest_progress``."""

    def save(updates: DataFrame, batch: int) -> None:
        updates.write.mode("overwrite").parquet(_version(path, batch))

    writer = progress_stream(responses, every, delay).writeStream.outputMode("update").foreachBatch(save)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_progress(spark: SparkSession, path: str) -> DataFrame:
    """Last state of every window."""
    saved = spark.read.parquet(path)
    row = F.struct("completed", "failed")
    return saved.groupBy("window_start").agg(F.max_by(row, "batch").alias("r")).select("window_start", "r.*")


BUCKETS = 16  # of a result table: more for a larger one, a bucket is rewritten whole


def _heads(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The newest version of every bucket (of the versions below ``before``): one row per bucket and batch is read."""
    try:
        heads = spark.read.parquet(f"{path}/heads")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}  # nothing has been landed
    known = heads if before is None else heads.filter(F.col("version") < before)
    return {r["bucket"]: r["version"] for r in known.groupBy("bucket").agg(F.max("version").alias("version")).collect()}


def _versions(spark: SparkSession, path: str, heads: dict[int, int]) -> DataFrame | None:
    """The results in the given versions: the filter is on folders, so that no others are read."""
    if not heads:
        return None
    chosen = reduce(lambda a, b: a | b, [(F.col("version") == v) & (F.col("bucket") == b) for b, v in heads.items()])
    return spark.read.parquet(f"{path}/data").filter(chosen).select("input", "index", "body")


def _latest(results: DataFrame) -> DataFrame:
    return results.groupBy("input").agg(F.max_by(F.struct("index", "body"), "index").alias("r")).select("input", "r.*")


def stream_refresh(responses: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Land results for a refresh in a table of buckets by the hash of the input; see ``refreshed``.

    A micro-batch keeps the last good result per input, merges it with the newest version of the buckets it touches (the largest ``index``
    wins, in whatever order results arrive) and writes these as a version of its own, then lists them as heads. Other buckets are
    neither read nor written. A replayed batch reads the same older versions and overwrites its own.
    """

    def save(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        good = rows.filter(~F.col("skipped") & F.col("error").isNull() & (F.octet_length(F.col("body").cast("binary")) > 0))
        fresh = _latest(good.select("input", F.col("index").cast("long").alias("index"), F.col("body").cast("string").alias("body")))
        dealt = cut_lineage(fresh.withColumn("bucket", F.pmod(F.xxhash64("input"), F.lit(buckets)).cast("int")))
        touched = {r["bucket"] for r in dealt.select("bucket").distinct().collect()}
        if not touched:
            return
        older = _versions(spark, path, {b: v for b, v in _heads(spark, path, batch).items() if b in touched})
        merged = dealt.drop("bucket") if older is None else _latest(dealt.drop("bucket").unionByName(older))
        placed = merged.withColumn("bucket", F.pmod(F.xxhash64("input"), F.lit(buckets)).cast("int"))
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={batch}")
        dealt.select("bucket").distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/heads/version={batch}")

    writer = responses.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def current_results(spark: SparkSession, path: str) -> DataFrame:
    """The last good result of every input, as responses: one version of each bucket is read."""
    found = _versions(spark, path, _heads(spark, path))
    if found is None:
        found = spark.createDataFrame([], "input string, index long, body string")
    return found.withColumns({"skipped": F.lit(False), "error": F.lit(None).cast("string")})


def refreshed(table: DataFrame, key: str, path: str, columns: Sequence[str]) -> DataFrame:
    """The table with the landed results merged in: per input the one with the largest ``index``, in
    whatever order and batch the results arrived. ``columns`` names the columns that results may add."""
    landed = current_results(table.sparkSession, path)
    missing = [c for c in columns if c not in table.columns]
    widened = table.withColumns({c: F.lit("") for c in missing}) if missing else table
    return refresh_table(widened, key, landed, [], columns)


def stream_changes(
    observations: DataFrame, path: str, log: str, checkpoint: str, key: str, order: Sequence[str], value: str
) -> StreamingQuery:
    """Every arriving observation with the previous value of its item; see ``latest_changes``.

    Observations are appended to ``log``, one folder per micro-batch. A batch reads back only the items it
    touches, from each one's last row before the first new one on, so a late row gets its true predecessor, and the
    row after it is written again with its corrected one. Output and log only grow; neither
    is rewritten.
    """
    place = F.struct(*order)

    def step(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        new = rows.select(key, *order, value)
        new.write.mode("overwrite").parquet(_version(log, batch))
        arrived = spark.read.parquet(_version(log, batch)).withColumn("__new", F.lit(True))
        known = spark.read.parquet(log).filter(F.col("batch") < batch).drop("batch")
        first = arrived.groupBy(key).agg(F.min(place).alias("__first"))
        near = known.join(first, key).withColumn("__before", place < F.col("__first"))
        kept = near.filter("not __before").select(*new.columns)
        lasts = near.filter("__before").groupBy(key).agg(F.max_by(F.struct(*order, value), place).alias("r")).select(key, "r.*")
        current = arrived.unionByName(kept.unionByName(lasts).withColumn("__new", F.lit(False)))
        linked = with_previous(current, key, order, {"previous": value, "__after_new": "__new"})
        # new rows, and known ones that now follow a new one
        said = linked.filter(F.col("__new") | F.coalesce("__after_new", F.lit(False))).drop("__new", "__after_new")
        changed = F.coalesce(F.col("previous") != F.col(value), F.lit(False))
        said.withColumn("changed", changed).write.mode("overwrite").parquet(_version(path, batch))

    writer = observations.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest_changes(spark: SparkSession, path: str, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Every observation once, with the last word on its previous value."""
    saved = spark.read.parquet(path)
    row = F.struct(value, "previous", "changed")
    return saved.groupBy(key, *order).agg(F.max_by(row, "batch").alias("r")).select(key, *order, "r.*")
