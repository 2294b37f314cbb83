"""Hard negatives and near-duplicate embeddings against brute force, with nulls, ties, copies and odd lengths."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm.embedding_duplicates import MultiIndex, MultiIndexParams, embedding_duplicates, fit, roots, squared, unit
from gleaner.llm.hard_negatives import HardNegativeParams, hard_negatives, vertical_scan

SMALL = HardNegativeParams(block=32, anchor_block=8, step=3, few=2)


def wanted_negatives(rows, anchors):
    """By the definition, on ``(vec_id, label, values)`` without repeats."""
    out = set()
    for i, label, x in rows:
        if i not in anchors:
            continue
        scored = [(sum(a * b for a, b in zip(x, y, strict=True)), j, m) for j, m, y in rows if j != i and len(x) == len(y)]
        scored.sort(key=lambda t: (-t[0], t[1]))
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(s, k) for s, k, m in scored if m != label and 80 * p <= 100 * s <= 100 * p][:5]
            out |= {(i, j, n, k, p, s) for n, (s, k) in enumerate(fits, 1)}
    return out


@pytest.mark.parametrize("largest", [40, 2**30])  # sums in doubles, then in longs only
def test_hard_negatives_brute_force(spark, largest):
    rng = random.Random(largest)
    base = [[rng.randint(-largest, largest) for _ in range(9)] for _ in range(30)]
    rows = []
    for i in range(160):
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):  # many equal and nearly equal vectors: ties everywhere
            x[rng.randrange(9)] += rng.randint(-2, 2)
        rows.append((i, rng.randint(0, 2), x))
    rows += [(500 + i, 0, [largest, i]) for i in range(4)] + [(600, 1, []), (601, 1, []), (602, 2, [])]
    odd = [(None, 1, [1] * 9), (700, None, [1] * 9), (701, 1, None), (702, 1, [1] * 8 + [None]), (703, 1, [2**62] * 9)]
    given = rows + odd + rows[:20] + [(3, rows[3][1], rows[3][2])] * 30
    vectors = spark.createDataFrame(given, "vec_id long, label int, values array<long>").withColumn("dim", F.lit("clash")).repartition(7)
    anchors = [0, 10, 20, 30, 500, 600, 700, 701]
    got = hard_negatives(vectors, vectors.filter(F.col("vec_id").isin(anchors)), SMALL).collect()
    assert len({tuple(r) for r in got}) == len(got)
    assert {tuple(r) for r in got} == wanted_negatives(rows, anchors)
    assert any(r["anchor_id"] == 600 for r in got)


def test_hard_negatives_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, values array<long>")
    assert hard_negatives(empty, empty).count() == 0
    one = spark.createDataFrame([(1, 1, [5, 5])], empty.schema)
    assert hard_negatives(one, one).count() == 0


def test_vertical_scan_prunes():
    """Columns of small contributions are not read for candidates that cannot win any more."""
    rng = np.random.default_rng(1)
    columns = rng.integers(-5, 5, (40, 500)).astype(float)
    columns[0, :10] = 1000
    anchor = np.r_[50.0, np.ones(39)]
    looked = []

    def keep(lower, upper):
        looked.append(len(lower))
        return upper >= np.partition(lower, len(lower) - 5)[len(lower) - 5]

    live, score = vertical_scan(anchor, columns, columns.min(1), columns.max(1), np.arange(500), keep, HardNegativeParams(step=4, few=8))
    assert looked[1] == 10 and set(live) <= set(range(10))
    assert (score == anchor @ columns[:, live]).all()


def wanted_duplicates(rows, cosine):
    """``vec_id -> (links, component)`` for distinct ``(vec_id, vector)``."""
    able = {i: x for i, x in rows if x and all(c is not None and math.isfinite(c) for c in x) and any(x)}

    def cos(x, y):
        m, n = math.hypot(*x), math.hypot(*y)
        return math.fsum(a / m * (b / n) for a, b in zip(x, y, strict=True))

    links = {i: {j for j, y in able.items() if j != i and len(x) == len(y) and cos(x, y) >= cosine} for i, x in able.items()}
    out = {}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            more = links.get(todo.pop(), set()) - seen
            seen |= more
            todo += more
        out[i] = (len(links.get(i, ())), min(seen))
    return out


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    rows = []
    for centre in unit(rng.standard_normal((12, 16))):
        rows += [(centre + 0.07 * rng.standard_normal(16) * rng.random()).tolist() for _ in range(25)]
    rows += unit(rng.standard_normal((60, 16))).tolist()
    rows += [rows[0]] * 20 + [(np.array(rows[1]) * 1e200).tolist(), (np.array(rows[1]) * 1e-200).tolist()]
    rows += [[1.0, 2.0, 3.0], [1.0, 2.0, 3.1], [3.0, -1.0, 0.0], [2.0], [-2.0], [5.0]]
    rows += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15]
    return list(enumerate(rows))


@pytest.mark.parametrize("recall", [1.0, 0.999])
def test_embedding_duplicates_brute_force(spark, clustered, recall):
    params = MultiIndexParams(cell=4, bucket=24, query_block=16, target_recall=recall)
    given = [*clustered, *clustered[:30], (None, [1.0] * 16)]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash")).repartition(5)
    got = embedding_duplicates(vectors, params).collect()
    assert len(got) == len(given)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None} == wanted_duplicates(clustered, 0.95)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert [tuple(r) for r in got if r["vec_id"] is None] == [(None, 0, None, True)]


def test_embedding_duplicates_floats_and_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_duplicates(empty).count() == 0
    few = spark.createDataFrame([(5, [1.0, 0.5]), (3, [2.0, 1.0]), (9, [0.5, -1.0]), (9, [1.0, 0.5])], empty.schema)
    got = {tuple(r) for r in embedding_duplicates(few).collect()}
    assert {r[:3] for r in got if r[0] != 9} <= {(5, 1, 3), (3, 1, 3), (5, 2, 3), (3, 2, 3)} and len({r for r in got if r[0] == 9}) == 1


def test_multi_index_recall_and_order():
    """Visits come in the order of distance, stop at the limit, and reach the partners that the target promises."""
    rng = np.random.default_rng(5)
    points = unit(rng.standard_normal((4000, 24)))
    index = fit(points, len(points), MultiIndexParams(target_recall=0.99, cell=8))
    asked = points[:500]
    aside = rng.standard_normal(asked.shape)
    aside -= (aside * asked).sum(1, keepdims=True) * asked
    partners = index.cells(0.95 * asked + math.sqrt(1 - 0.95**2) * unit(aside))
    row, cell = index.visits(asked)
    first, second = index.costs(asked)
    cost = first[row, cell // index.words] + second[row, cell % index.words]
    assert (cost <= index.limit).all()
    assert all((np.diff(cost[row == i]) >= 0).all() for i in range(500))
    everything = first[:, :, None] + second[:, None, :] <= index.limit
    assert len(cell) == everything.sum() and len(cell) < 0.5 * everything.size
    assert np.mean([partners[i] in cell[row == i] for i in range(500)]) >= 0.97


def test_visits_at_full_recall_hold_every_partner():
    rng = np.random.default_rng(6)
    points = unit(rng.standard_normal((600, 8)))
    points = np.concatenate([points, unit(points + 0.09 * rng.standard_normal(points.shape))])
    index = fit(points, len(points), MultiIndexParams(target_recall=1.0, cell=8))
    cells = index.cells(points)
    row, cell = index.visits(points)
    seen = set(zip(row.tolist(), cell.tolist(), strict=True))
    i, j = np.nonzero(points @ points.T >= 0.95)
    assert all((a, cells[b]) in seen for a, b in zip(i.tolist(), j.tolist(), strict=True))


def test_roots():
    rng = random.Random(2)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(60, 99)]
    a, b = np.array(links).T
    label = list(range(100))
    for _ in range(100):
        for x, y in links:
            label[x] = label[y] = min(label[x], label[y])
    assert roots(a, b, 100).tolist() == label


def test_squared_and_one_cell():
    x = np.array([[1.0, 2.0], [0.0, 0.0]])
    assert squared(x, x).tolist() == [[0.0, 5.0], [5.0, 0.0]]
    index = MultiIndex((np.zeros((1, 1)), np.zeros((1, 1))))
    row, cell = index.visits(x)
    assert row.tolist() == [0, 1] and cell.tolist() == [0, 0]
