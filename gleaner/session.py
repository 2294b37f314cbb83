"""Session helpers shared by the tests, the bench and the iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "gleaner", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GLEANER_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session that names none (a test on one machine) gets a fresh local
    folder; on a cluster an unset folder is an error, since a machine-local
    one would be lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="gleaner-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that lost executors do not replay a whole loop."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_to_files(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Like ``cut_lineage``, in column files: smaller, and quicker to read where rows are read many times."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/columns-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made and run in here leave no shuffle files behind, so that a job of many steps takes the disk of its largest step.

    Else the files stay until the driver happens to collect its garbage. A frame that is to be run later is made outside."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
