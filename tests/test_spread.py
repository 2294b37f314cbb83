"""How rows that are costly to work on are spread over tasks."""

from pyspark.sql import functions as F

from gleaner.operators import rows


def test_tasks_grow_with_the_input_and_rows_travel_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(200_000).withColumn("body", F.md5(F.col("id").cast("string"))).coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    monkeypatch.setattr(rows, "TASK_INPUT", 64 * 1024)
    spread = rows.spread_costly(table)
    assert spread.rdd.getNumPartitions() > 4 * spark.sparkContext.defaultParallelism  # one split, many tasks
    again = rows.spread_costly(spread.filter("id % 2 = 0").withColumn("text", F.upper("body")))
    assert again.select("text")._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 1
    assert again.agg(F.sum("id")).first()[0] == sum(range(0, 200_000, 2))
    small = rows.spread_costly(spark.read.parquet(path).limit(5))
    assert small.count() == 5


def test_rows_in_order_are_worked_on_once(spark):
    """A sort after the work samples its rows first, which does the work twice."""
    done = spark.sparkContext.accumulator(0)

    def work(batches):
        for batch in batches:
            done.add(batch.num_rows)
            yield batch

    docs = spark.range(1000).selectExpr("(id * 7) % 1000 as id", "'x' as body").repartition(3)
    worked = rows.spread_costly(rows.spread_in_order(docs, "id")).mapInArrow(work, "id long, body string").sortWithinPartitions("id")
    assert [r.id for r in worked.collect()] == list(range(1000))
    assert done.value == 1000


def test_payload_files_share_tasks(spark, tmp_path):
    """Many small files are read by few tasks, and all of them are read."""
    from gleaner.sources.files import read_payload_dir

    (tmp_path / "more").mkdir()
    for n in range(120):
        (tmp_path / ("more" if n % 2 else "") / f"{n}.txt").write_text(f"text {n}")
    (tmp_path / "7.err").write_text("error")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a split per file
    try:
        found = read_payload_dir(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() <= max(4 * spark.sparkContext.defaultParallelism, 8)
        assert sorted((r.n, bytes(r.body)) for r in found.collect()) == [(n, b"text %d" % n) for n in range(120)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_payload_files_are_listed_in_tasks(spark, tmp_path):
    """The plan on the driver names none of the files; what is found is what Spark's own source finds."""
    from gleaner.sources.files import number_payloads, read_payload_dir

    want = {}
    for n, name in enumerate(["1.txt", "a/2.html", "a/b/3", "a/b/13", "a/b c/4.json", "a/[5]/5.md", "6.é.txt", "_left/7.txt", ".left/8.txt", "_k=1/9.txt", "10.err", "note.txt", "11.", " 12 .txt"], 1):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(bytes([n]) * n if name != "a/b/13" else b"")
        want[name] = (tmp_path / name).read_bytes()
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nowhere")
    found = read_payload_dir(spark, str(tmp_path))
    assert not any(file.startswith(f"file://{tmp_path}/") for file in found.inputFiles())
    got = {r.file: (r.n, r.ext, bytes(r.body)) for r in found.collect()}
    named = {"1.txt": 1, "a/2.html": 2, "a/b/3": 3, "a/b c/4.json": 4, "a/[5]/5.md": 5, "_k=1/9.txt": 9, "11.": 11, " 12 .txt": 12}
    assert got == {name: (n, "" if n == 3 else name.rpartition(".")[2], want[name]) for name, n in named.items()}
    source = number_payloads(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)), "path", str(tmp_path))
    assert got == {r.file: (r.n, r.ext, bytes(r.content)) for r in source.collect()}
    assert sorted(r.n for r in read_payload_dir(spark, f"{tmp_path}/a/2*").collect()) == [2]  # a pattern
    (tmp_path / "empty").mkdir()
    assert read_payload_dir(spark, str(tmp_path / "empty")).collect() == []
