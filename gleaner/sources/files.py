"""Readers for input lists, numbered payload folders, manifests and the audit log.

Each reader is a Spark scan plus an operator on its rows; the operators also take tables.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_lossy, strip
from ..operators.inputs import clean_lines
from ..operators.ordered import first_n, numbered
from ..operators.rows import FILE_SPLIT, explode_rows
from ..session import cut_to_files


def _require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no non-empty lines")
    return df


def index_inputs(lines: DataFrame, *order: str, value: str = "value") -> DataFrame:
    """Blank-free inputs with a dense 0-based index in the given order."""
    kept = clean_lines(lines, value).select(*order, F.col(value).alias("input"))
    return numbered(kept, order, "index").select("index", "input")


FILE_ORDER = ("__file", "__block", "__row")


def _in_file_order(scan: DataFrame) -> DataFrame:
    """Add the place of every row of a file scan: file, block, row within the scan task."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )


def read_input_lines(spark: SparkSession, path: str) -> DataFrame:
    """One input per line: stripped, without blank lines, numbered in file order."""
    return _require_rows(index_inputs(_in_file_order(spark.read.text(path)), *FILE_ORDER), path)


def has_header(first_cell: str | None) -> bool:
    """The first row of an input table is a header unless it starts with a URL or a path."""
    return first_cell is not None and not first_cell.strip().startswith(("http://", "https://", "/"))


def read_input_column(
    spark: SparkSession, path: str, column: str | int | None = None, multi_line: bool = False
) -> DataFrame:
    """Inputs from one column of a CSV file, by name or 0-based position (default: the first)."""
    raw = spark.read.option("multiLine", multi_line).option("escape", '"').csv(path)
    first = raw.first()
    if first is None:
        raise ValueError(f"{path} has no rows")
    header = [(cell or "").strip() for cell in first]
    named = column is not None and not str(column).isdigit()
    if named and column not in header:
        raise ValueError(f"column {column!r} not found in CSV header: {header}")
    position = header.index(column) if named else int(column or 0)
    if position >= len(header):
        raise ValueError(f"{path} has no column {position}")
    if named or has_header(first[0]):
        raw = spark.read.option("multiLine", multi_line).option("escape", '"').csv(path, header=True)
    placed = _in_file_order(raw)
    cells = placed.toDF(*[f"c{i}" for i in range(len(raw.columns))], *FILE_ORDER)
    lines = cells.select(F.col(f"c{position}").alias("value"), *FILE_ORDER)
    return _require_rows(index_inputs(lines, *FILE_ORDER), path)


def number_payloads(df: DataFrame, path: str, root: str = "") -> DataFrame:
    """Payloads of files named ``N.ext``: add ``n``, ``file`` (path below ``root``) and ``ext``.

    Error files and names that are no number are left out.
    """
    below = F.col(path)
    if root:
        below = F.regexp_replace(below, r"^.*?" + _quote(root.rstrip("/")) + "/", "")
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    stem = F.when(name.contains("."), F.regexp_extract(name, r"(?s)^(.+)\.[^.]*$", 1)).otherwise(name)
    ext = F.regexp_extract(name, r"(?s)^.+\.([^.]*)$", 1)
    return (
        df.withColumns({"n": strip(stem).try_cast("bigint"), "file": below, "ext": ext})
        .filter(F.col("n").isNotNull() & (F.col("ext") != "err"))
    )


def _quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def write_payload_files(payloads: DataFrame, file: str, body: str, folder: str) -> None:
    """One file per row below ``folder``: its path there in ``file``, its bytes in ``body``.

    Spark's file writers name their files themselves; a task writes each of its rows through the folder's Hadoop or local
    file system, to a name of its own first, so that a repeated task replaces whole files.
    """
    from pyarrow import fs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spark names local folders file:/…, with one slash
        store, root = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder) if ":" in folder else f"file://{folder}")
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                target = f"{root}/{name}"
                store.create_dir(target.rpartition("/")[0], recursive=True)
                own = f"{target}.{uuid.uuid4().hex}.err"
                with store.open_output_stream(own) as out:
                    out.write(content.as_buffer() if content.is_valid else b"")
                store.move(own, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    payloads.select(file, F.col(body).cast("binary")).mapInArrow(run, "n long").agg(F.sum("n")).collect()


SPLITS_PER_TASK = 16  # a split is a few dozen small files, soon read
OPEN_COST = 4 * 1024 * 1024  # what a file counts besides its bytes, as when Spark makes splits
READ_BATCH = 8 * 1024 * 1024  # bytes of files that a task hands on at once
LISTED = "file string, size long, folder boolean"


def _fewer_tasks(files: DataFrame) -> DataFrame:
    """Small files in fewer tasks, whose number still grows with the folder: a file counts as 4 MB when Spark makes splits."""
    splits = files.rdd.getNumPartitions()
    wanted = max(4 * files.sparkSession.sparkContext.defaultParallelism, splits // SPLITS_PER_TASK)
    return files.coalesce(wanted) if splits > wanted else files


def _open_store(folder: str):
    """The file system that holds a qualified folder, and the folder's path there."""
    from pyarrow import fs

    local = re.match(r"file:/+", folder)
    return (fs.LocalFileSystem(), f"/{folder[local.end():]}") if local else fs.FileSystem.from_uri(folder)


def _folder(spark: SparkSession, path: str) -> str | None:
    """The qualified name of a folder that tasks can list; None for patterns, files and stores that only Spark reads."""
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not store.getFileStatus(at).isDirectory():
            return None
        folder = store.makeQualified(at).toString()
        _open_store(folder)
    except Exception:  # Spark's own reader says what is wrong, or reads it
        return None
    return folder


def _passed_over(name: str) -> bool:
    """Names that Spark's readers pass over."""
    hidden = name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name
    return hidden and not name.startswith(("_metadata", "_common_metadata"))


def _listing(folders: DataFrame, folder: str, deep: bool) -> DataFrame:
    """``file, size, folder``: what stands in each of the folders named ``file`` below ``folder``, or else the files at any depth."""

    def entries(store, place: str) -> Iterator[tuple[str, int, bool]]:
        if store.type_name == "local":
            with os.scandir(place) as found:  # one after the other: a folder can hold millions
                for entry in found:
                    try:
                        is_folder = entry.is_dir()
                        yield entry.name, 0 if is_folder else entry.stat().st_size, is_folder
                    except FileNotFoundError:  # a link to nowhere
                        continue
        else:
            from pyarrow import fs

            for info in store.get_file_info(fs.FileSelector(place)):
                yield info.base_name, info.size or 0, info.type == fs.FileType.Directory

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_store(folder)
        rows: list[tuple[str, int, bool]] = []
        taken = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), (pa.string(), pa.int64(), pa.bool_()))], ["file", "size", "folder"])
        for batch in batches:
            waiting = batch.column(0).to_pylist()
            while waiting:
                below = waiting.pop()
                for name, size, is_folder in entries(store, f"{root}/{below}" if below else root):
                    if _passed_over(name):
                        continue
                    name = f"{below}/{name}" if below else name
                    if deep and is_folder:
                        waiting.append(name)
                        continue
                    rows.append((name, size, is_folder))
                    if len(rows) >= 10_000:
                        yield taken()
                        rows.clear()
        yield taken()

    return folders.select("file").mapInArrow(run, LISTED)


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """``file, size`` of the files below a folder, found in tasks: the folder's own, then those of each folder in it. Files without
    a byte are passed over, as by Spark's source."""
    top = cut_to_files(_listing(spark.range(0, 1, 1, 1).select(F.lit("").alias("file")), folder, deep=False))
    inner = top.filter("folder").repartition(4 * spark.sparkContext.defaultParallelism)
    files = top.filter("not folder").unionByName(_listing(inner, folder, deep=True))
    return cut_to_files(files.filter("size > 0").select("file", "size"))


def _with_bodies(files: DataFrame, folder: str) -> DataFrame:
    """``n, file, ext`` and the bytes of each file as ``body``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_store(folder)
        for batch in batches:
            begin, bodies, held = 0, [], 0
            for i, name in enumerate(batch.column("file").to_pylist()):
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    bodies.append(source.read())
                held += len(bodies[-1])
                if held >= READ_BATCH or i == batch.num_rows - 1:
                    part = batch.slice(begin, len(bodies))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bodies, pa.binary())], ["n", "file", "ext", "body"])
                    begin, bodies, held = i + 1, [], 0

    return files.select("n", "file", "ext").mapInArrow(run, "n long, file string, ext string, body binary")


def read_payload_dir(spark: SparkSession, path: str) -> DataFrame:
    """Numbered payload files below a folder: ``n, file, ext, body``.

    Spark's own source lists all files on the driver, which takes memory for each. Here tasks list them, and only their names are
    kept, in the shared checkpoint folder; a task reads its files one after the other. Patterns, single files and stores that only Spark
    reads are left to that source.
    """
    folder = _folder(spark, path)
    if folder is None:
        files = _fewer_tasks(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))
        return number_payloads(files, "path", path).select("n", "file", "ext", F.col("content").alias("body"))
    files = number_payloads(_listed(spark, folder).withColumn("path", F.concat(F.lit("/"), "file")), "path").withColumn("file", F.expr("substring(path, 2)"))
    splits, found = files.agg(F.sum(F.col("size") + OPEN_COST), F.count("*")).first()
    wanted = max(4 * spark.sparkContext.defaultParallelism, (splits or 0) // (SPLITS_PER_TASK * FILE_SPLIT))
    return _with_bodies(files.repartition(max(1, min(wanted, found))), folder)


MANIFEST_FIELDS = {
    "http_status": "int", "credits_used": "int", "latency_ms": "int", "content_sha256": "string",
}


def manifest_entries(df: DataFrame, json_text: str) -> DataFrame:
    """Manifest objects as rows, old form (input -> file name) and new form (input -> entry)."""
    whole = F.try_variant_get(F.try_parse_json(json_text), "$", "map<string,variant>")
    entries = explode_rows(df, [], F.map_entries(whole), "__e")
    value = F.col("__e.value")
    field = lambda name, kind: F.try_variant_get(value, f"$.{name}", kind)
    file = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise(
        field("file", "string")
    )
    rows = entries.select(
        F.col("__e.key").alias("input"),
        file.alias("file"),
        F.try_to_timestamp(field("fetched_at", "string")).alias("fetched_at"),
        *[field(name, kind).alias(name) for name, kind in MANIFEST_FIELDS.items()],
    )
    return rows.filter(F.col("file").isNotNull())


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``input, file`` and, from the new form, the entry's other fields."""
    return manifest_entries(spark.read.text(path, wholetext=True), "value")


AUDIT_COLUMNS = ("feature", "command", "input", "output_dir")


def parse_audit(lines: DataFrame, line: str) -> DataFrame:
    """Log lines as columns; ``ts`` is null where the line does not start with a timestamp."""
    parts = F.split(F.col(line), r" \| ", -1)
    cells = {name: F.get(parts, F.lit(i + 1)) for i, name in enumerate(AUDIT_COLUMNS)}
    return lines.withColumns({"ts": F.try_to_timestamp(F.btrim(F.get(parts, F.lit(0)))), **cells})


def filter_audit(
    lines: DataFrame,
    line: str,
    order: str | Sequence[str],
    n: int = 50,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Lines between two instants, both included (lines without a timestamp are dropped); without
    instants the last ``n`` lines."""
    rows = parse_audit(lines, line)
    if since is None and until is None:
        return first_n(rows, [order] if isinstance(order, str) else order, n, descending=True)
    keep: Column = F.col("ts").isNotNull()
    if since is not None:
        keep = keep & (F.col("ts") >= F.lit(since))
    if until is not None:
        keep = keep & (F.col("ts") <= F.lit(until))
    return rows.filter(keep)


def read_audit_log(spark: SparkSession, path: str, **kwargs) -> DataFrame:
    """Log lines in file order: files by path, lines by place."""
    return filter_audit(_in_file_order(spark.read.text(path)), "value", FILE_ORDER, **kwargs)


AUDIT_LIMIT = 10_000


def retain_last_n(df: DataFrame, *order: str, n: int = AUDIT_LIMIT) -> DataFrame:
    """Keep the newest ``n`` entries."""
    return first_n(df, order, n, descending=True)


# The names under which a usage report may state the limits, in order of preference.
CONCURRENCY_KEYS = ("max_concurrent_requests", "concurrent_request_limit", "concurrency", "concurrent_requests")
CREDIT_KEYS = (
    "credits", "available_credits", "credit_balance", "balance", "credits_remaining", "remaining_credits",
)
DEFAULT_CONCURRENCY = 5
MAX_CONCURRENCY = 10_000


def quota_from_usage(df: DataFrame, body: str, *keep: str) -> DataFrame:
    """Credits left and allowed concurrency from a usage report (JSON)."""
    report = F.try_parse_json(decode_lossy(F.col(body)))

    def number(key: str) -> Column:
        value = F.try_variant_get(report, f"$.{key}", "variant")
        kind = F.schema_of_variant(value)
        # text that looks like a number is not one
        return F.when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"), F.try_variant_get(value, "$", "double"))

    def first_valid(candidates: list[Column]) -> Column:
        return F.coalesce(*candidates)

    used = F.floor(number("max_api_credit")) - F.floor(number("used_api_credit"))
    left = F.when(used >= 0, used)
    stated = F.floor(number("max_concurrency"))
    allowed = F.when((stated > 0) & (stated <= MAX_CONCURRENCY), stated)
    other_allowed = first_valid(
        [F.when((number(k) > 0) & (number(k) <= MAX_CONCURRENCY), F.floor(number(k))) for k in CONCURRENCY_KEYS]
    )
    other_left = first_valid([F.when(number(k) >= 0, F.floor(number(k))) for k in CREDIT_KEYS])
    # the default and zero count as "not stated" and fall through to the other names
    return df.select(
        *keep,
        F.coalesce(F.when(left != 0, left), other_left, F.lit(0)).cast("long").alias("credits"),
        F.coalesce(
            F.when(allowed != DEFAULT_CONCURRENCY, allowed), other_allowed, F.lit(DEFAULT_CONCURRENCY)
        ).cast("int").alias("max_concurrency"),
    )
