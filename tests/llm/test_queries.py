"""The registered queries of the pipeline operators on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, oracle_connection
from gleaner.llm import toxicity
from gleaner.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_oracle(spark, name):
    ok, note = compare(spark, oracle_connection(SF_DIR), SF_DIR, name, QUERIES[name], ORACLES[name])
    assert ok, note


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_toxicity_held_out(spark):
    got = QUERIES["op3_toxicity"](spark, SF_DIR).collect()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_neighbours_recall(spark):
    import numpy as np

    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.array([r[1] for r in rows], np.float64)
    place = {r[0]: i for i, r in enumerate(rows)}
    found = Counter()
    got = QUERIES["op1_neighbours"](spark, SF_DIR).collect()
    for q in (r[0] for r in rows if r[0] % 20 == 0):
        s = x @ x[place[q]]
        s[place[q]] = -np.inf
        want = {rows[i][0] for i in np.argsort(-s, kind="stable")[:20]}
        found["all"] += len(want)
        found["hit"] += len(want & {r["vec_id"] for r in got if r["query_id"] == q})
    assert found["hit"] >= 0.9 * found["all"]


def test_sharding_contract(spark):
    got = QUERIES["op8_sharding"](spark, SF_DIR).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert {r["doc_id"]: r["size"] for r in got} == {d: len((t or "").encode()) + 16 for d, t in docs.items()}
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts[s] for s in range(40)) <= 1 and set(counts) <= set(range(40))
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))


# the stage links at four fifths of five-word shingles, op5's contract at 85 percent of three-word ones
NEAR_SQL = (
    ORACLES["op5_near_duplicates"].replace("len(ws) < 3", "len(ws) < 5").replace("len(ws) - 1)", "len(ws) - 3)")
    .replace("ws[i:i + 2]", "ws[i:i + 4]").replace(">= 85 *", ">= 80 *")
)


def test_pipeline(spark):
    """Every stage against its own rule on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    con = oracle_connection(SF_DIR)
    ids = sorted(r["doc_id"] for r in docs.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    rest = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rest, SF_DIR).cache()
        before, after = ids, sorted(r["doc_id"] for r in out.select("doc_id").collect())
        con.execute("DROP VIEW IF EXISTS documents")
        con.register("kept", rest.toPandas())
        con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM kept")
        if name == "toxicity":
            judged = toxicity.judge(rest, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            assert after == sorted(r["doc_id"] for r in judged.filter(F.col("toxicity") < 0.7).collect())
        elif name == "near_duplicates":
            assert after == sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({NEAR_SQL}) WHERE kept").fetchall())
        elif name == "decontamination":
            bad = {r[0] for r in con.execute(f"SELECT DISTINCT doc_id FROM ({ORACLES['op6_decontamination']})").fetchall()}
            assert after == [i for i in before if i not in bad]
        elif name == "mixing":
            assert after == sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op2_mixing']})").fetchall())
            assert set(after) == set(before)
        else:
            assert after == before and out.columns == [*docs.columns, "shard", "slot"]
        assert name == "sharding" or out.columns == docs.columns
        ids, rest = after, out
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(ids)


def test_near_duplicate_stage(spark):
    """The stage against sets of shingles, with doc_ids that come with several texts."""
    import random

    rng = random.Random(4)

    def prose(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def sets(text):
        words = (text or "").split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    rows = []
    for i in range(30):
        base = prose(200)
        scattered, longer = list(base), base + prose(rng.randint(20, 46))
        for at in (20, 70, 120, 160, 180)[: rng.randint(2, 5)]:
            scattered[at] = "changed"
        rows += [(10 * i, " ".join(base)), (10 * i + 1, " ".join(scattered)), (10 * i + 2, " ".join(longer))]
    first, copied, alone = rows[0][1], " ".join(prose(50)), " ".join(prose(50))
    rows += [(400, copied), (900, first), (900, alone), (900, alone), (901, copied), (901, " ".join(prose(50))), (902, None), (902, alone + " x y z"), (903, ""), (None, first)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF_DIR).collect())

    texts = sorted({r for r in rows if r[0] is not None}, key=str)
    group = {r: r for r in texts}

    def find(r):
        while group[r] != r:
            r = group[r]
        return r

    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            x, y = sets(a[1]), sets(b[1])
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                group[find(a)] = find(b)
    members = {}
    for r in texts:
        members.setdefault(find(r), []).append(r)
    rest = {r for r in got if r[0] is not None}
    assert got[None, first] == 1 and set(got.values()) == {1}
    for same in members.values():  # one of each group: of the smallest doc_id, if that has but one text
        kept = [r for r in same if r in rest]
        assert len(kept) == 1
        if sum(r[0] == min(same, key=lambda s: s[0])[0] for r in texts) == 1:
            assert kept == [min(same, key=lambda r: r[0])]
    assert len(rest) == len(members)


CLASHES = ["toxicity", "Rejected", "mix_weight", "shard", "component_id", "kept", "n", "component", "__id"]


def test_stages_keep_clashing_columns(spark):
    """Columns that carry the stages' own names keep their values; only the last stage replaces shard and slot."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(120)
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in CLASHES[:-1]})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name == "sharding":
            assert sorted(out.columns) == sorted({*docs.columns, "shard", "slot"})
            continue
        assert out.columns == docs.columns
        kept = out.filter(" or ".join(f"{c} != concat('{c} of ', doc_id)" for c in CLASHES[:-1]))
        assert kept.count() == 0 and out.count() > 0


def test_stages_on_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.count() == 0 and out.columns[: len(docs.columns)] == docs.columns
        docs = spark.createDataFrame([], out.schema) if name != "sharding" else docs


def test_rows_that_differ_in_other_columns(spark):
    """Of rows that repeat a doc_id and text, the same one stays however the table is partitioned."""
    rows = [(1, "one two three four five six", "b", None), (1, "one two three four five six", "a", 3), (1, "one two three four five six", "a", 2), (2, None, "x", 1), (None, "t", "y", 1), (None, "t", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    for parts in (1, 3, 5):
        got = corpus_pipeline.near_duplicate_stage(spark, docs.repartition(parts), SF_DIR).collect()
        assert Counter(tuple(r) for r in got) == Counter([rows[2], rows[3], rows[4], rows[5]])
