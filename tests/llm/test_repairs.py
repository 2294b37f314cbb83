"""Places under any partitioning, mixtures at the ends of their range, very long texts against short items."""

import math
import resource
import random

import pytest

from gleaner.llm import decontamination, mixing, sharding


def test_shards_do_not_depend_on_partitions(spark):
    rows = [(7, f"text {i % 390}", i % 3) for i in range(400)] + [(i, "same", 0) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    places = []
    for parts, ties in ((3, ["text", "n"]), (7, ["text", "n"]), (1, ["n", "text", "gone"])):
        got = sharding.shard(docs.repartition(parts), sharding.RingParams(shards=5), ties=ties)
        places.append(sorted((r["doc_id"], r["text"], r["n"], r["shard"], r["slot"]) for r in got.collect()))
    assert places[0] == places[1]
    assert len({(s, t) for *_, s, t in places[2]}) == 500


def test_entropy_below_the_natural_one():
    tokens = {"a": 700, "b": 200, "c": 100}
    entropy = lambda w: -math.fsum(x * math.log(x) for x in w.values() if x > 0)
    for target in (0.1, 0.4, 0.8, 1.05):
        _, weights, _ = mixing.mixture(tokens, mixing.MixingParams(entropy=target))
        assert entropy(weights) == pytest.approx(target, abs=1e-6)
    exponent, weights, _ = mixing.mixture({"a": 5, "b": 5}, mixing.MixingParams(entropy=0.1))
    assert weights == {"a": 0.5, "b": 0.5}


def test_no_budget_gives_no_row(spark):
    docs = spark.createDataFrame([(i, "a b c", "s") for i in range(50)], "doc_id long, text string, source string")
    assert mixing.mix(docs, mixing.MixingParams(budget=0)).count() == 0


def test_items_in_a_very_long_text():
    """Items of one shingle make the narrowest windows; memory must not follow the text's length times the samples."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    text = [rng.choice(vocabulary) for _ in range(1_000_000)]
    items = [(1, " ".join(text[777_000:777_005])), (2, " ".join(text[-40:])), (3, "not in there at all"), (4, " ".join(text[4094:4110]))]
    params = decontamination.ContaminationParams()
    found = decontamination.signatures(items, params)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ((_, held),) = decontamination.matches(iter([" ".join(text)]), found, params)
    assert {found.ids[item] for item, _, _ in held} == {1, 2, 4}
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 500


def test_neighbours_of_queries_of_many_lengths(spark):
    """What most queries look like does not decide which of them are answered."""
    from gleaner.llm.neighbours import search

    rng = random.Random(1)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(40)]
    asked = [(100, [1.0] * 6), (101, [1.0, 2.0]), (102, [2.0, 1.0]), (103, [3.0, 1.0])]
    kind = "vec_id long, embedding array<double>"
    got = search(spark.createDataFrame(vectors, kind), spark.createDataFrame(asked, kind)).collect()
    want = sorted(vectors, key=lambda r: (-sum(r[1]), r[0]))[:20]
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [i for i, _ in want]
    assert {r["query_id"] for r in got} == {100}
