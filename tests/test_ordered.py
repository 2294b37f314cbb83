"""Order-dependent results: one exchange, hot instants, percentiles of skewed groups."""

import math
import random

from pyspark.sql import functions as F

from gleaner.operators import ledger, ordered


def test_one_exchange_of_whole_rows(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.lit("wide").alias("payload"))
    plan = ordered.running_totals(df, ["n"], {"sum": F.col("n")})._jdf.queryExecution().executedPlan().toString()
    carried = [line for line in plan.split("\n") if "Exchange hashpartitioning(__part" in line]
    assert len(carried) == 2 and plan.count("payload") > 0  # the rows, and the sums per range
    got = ordered.running_totals(df, ["n"], {"sum": F.col("n")}).collect()
    assert all(r["sum"] == r["n"] * (r["n"] + 1) // 2 for r in got) and len(got) == 5000


def test_hot_instant_is_spread(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, F.lit(5)).otherwise(F.col("id")).alias("at"), "id")
    sizes = [r["count"] for r in ordered.ranges(df, ["at", "id"]).groupBy("__part").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 1000
    numbered = ordered.numbered(df, ["at", "id"], "n", descending=True).collect()
    want = sorted(((r["at"], r["id"]) for r in numbered), reverse=True)
    assert [(r["at"], r["id"]) for r in sorted(numbered, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in numbered) == list(range(3000))


def test_percentiles(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(3000)]), None if rng.random() < 0.8 else "x") for _ in range(6000)]
    df = spark.createDataFrame(rows, "g string, latency_ms int, error string").repartition(3)
    at = lambda values, p: sorted(values)[max(0, math.ceil(len(values) * p) - 1)]
    for by in ((), ("g",)):
        for r in ledger.latency_report(df, *by).collect():
            own = [x for x in rows if not by or x[0] == r["g"]]
            known = [x[1] for x in own if x[1] is not None]
            assert (r["items"], r["failed"]) == (len(own), sum(x[2] is not None for x in own))
            assert (r["min_ms"], r["p50_ms"], r["p95_ms"], r["max_ms"]) == (min(known), at(known, 0.5), at(known, 0.95), max(known))
