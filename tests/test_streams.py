"""The result table of streamed refreshes: ten batches out of order against one batch, and what a read touches."""

import random
import re

from pyspark.sql import functions as F

from gleaner.operators.ledger import refresh_table
from gleaner.streaming import jobs

KIND = "input string, index long, body string, error string, skipped boolean"


def test_ten_batches_out_of_order(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for index in range(600):
        body = rng.choice(['{"price": %d}' % index, '{"price": %d, "tag": "t"}' % index, "", "no json"])
        rows.append((f"u{rng.randrange(90)}", index, body, rng.choice([None, None, None, "HTTP 500"]), rng.random() < 0.1))
    rng.shuffle(rows)
    table = spark.createDataFrame([(f" u{i} ", "old") for i in range(100)], "url string, price string")
    results, landed, cp = (str(tmp_path / n) for n in ("results", "landed", "cp"))
    assert jobs.refreshed(table, "url", results, ["tag"]).filter("price != 'old'").count() == 0  # nothing landed yet
    for part in range(10):
        spark.createDataFrame(rows[part * 60 : part * 60 + 60], KIND).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(KIND).parquet(landed)
        jobs.stream_refresh(stream, results, cp, buckets=8).awaitTermination()
    everything = spark.createDataFrame(rows, KIND)
    want = refresh_table(table.withColumn("tag", F.lit("")), "url", everything, [], ["tag"])
    got = jobs.refreshed(table, "url", results, ["tag"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert got.filter("price != 'old'").count() > 60
    # one version of each bucket, while older versions lie beside it
    current = jobs._versions(spark, results, jobs._heads(spark, results))
    folders = {tuple(re.search(r"version=(\d+)/bucket=(\d+)/", f).groups()) for f in current.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert len(folders) == len({b for _, b in folders}) == 8
    assert spark.read.parquet(f"{results}/data").select("version").distinct().count() == 10


def test_replayed_batch_changes_nothing(spark, tmp_path):
    """The heads below a batch are what its replay sees, whatever came after."""
    path = str(tmp_path / "r")
    for version, buckets in ((0, [1, 2]), (3, [2]), (5, [1])):
        spark.createDataFrame([(b,) for b in buckets], "bucket int").write.parquet(f"{path}/heads/version={version}")
    assert jobs._heads(spark, path) == {1: 5, 2: 3}
    assert jobs._heads(spark, path, 3) == {1: 0, 2: 0}
    assert jobs._heads(spark, path, 0) == {}


def test_tables_that_are_folders_or_files(spark, tmp_path):
    """A large table is a folder of files; its stream reads them all, and chunks of it are the chunks of its rows."""
    from gleaner.plans.base import stream
    from gleaner.plans.streams import stream_chunks

    rows = spark.createDataFrame([(i, f"text {i} ") for i in range(30)], "doc_id long, text string")
    rows.repartition(3).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    assert stream_chunks(spark, str(tmp_path / "folder")).count() == 30
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    (part,) = (tmp_path / "one").glob("*.parquet")
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "documents.parquet").write_bytes(part.read_bytes())
    (tmp_path / "file" / "other.parquet").write_bytes(part.read_bytes())
    for folder, name in (("folder", "folder-sink"), ("file", "file-sink")):
        out, cp = str(tmp_path / name), str(tmp_path / f"{name}-cp")
        jobs._run(stream(spark, str(tmp_path / folder), "documents"), cp, "parquet", out).awaitTermination()
        assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == list(range(30))
