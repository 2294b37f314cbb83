"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class NeighbourParams:
    """The index is fitted on ``sample`` vectors (smallest hashes of vec_id) and calibrated on the next
    ``probe_sample``: queries visit as many partitions as reach ``target_recall`` there. All vectors are indexed.
    ``vector_block`` and ``query_block`` bound what one task compares; ``partitions`` should grow with the
    table so that a partition holds some thousands of vectors to some hundred thousands."""

    k: int = 20
    partitions: int = 32
    sample: int = 12_000
    probe_sample: int = 600
    graph_degree: int = 10
    hidden: int = 96
    epochs: int = 25
    target_recall: float = 0.97
    vector_block: int = 4096
    query_block: int = 1024
    seed: int = 19


@dataclass
class Router:
    """A small network from a vector to the probability of each partition, and how many to visit."""

    scale: float
    layers: list[tuple[np.ndarray, np.ndarray]]
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        (w1, b1), (w2, b2) = self.layers
        return np.maximum(x * self.scale @ w1 + b1, 0) @ w2 + b2

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def nearest(queries: np.ndarray, points: np.ndarray, k: int, skip_own: bool = False) -> np.ndarray:
    """Places of the ``k`` largest inner products, block by block."""
    out = []
    for at in range(0, len(queries), 128):  # a block's products are a few megabytes
        s = queries[at : at + 128] @ points.T
        if skip_own:
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(np.negative(s, out=s), k - 1, axis=1)[:, :k].copy())
    return np.concatenate(out)


def balanced_parts(neighbours: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Split the nodes of a neighbour graph into ``parts`` of almost equal size that cut few edges.

    Recursive bisection at the median of an approximate second eigenvector of the random walk, then rounds in
    which nodes move to the part of most of their neighbours as long as sizes stay within five percent.
    """
    n = len(neighbours)
    u = np.repeat(np.arange(n), neighbours.shape[1])
    v = neighbours.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    label = np.zeros(n, int)
    sizes = {0: parts}
    while any(s > 1 for s in sizes.values()):
        following, fresh, names = {}, np.zeros(n, int), 0
        for part, share in sizes.items():
            nodes = np.flatnonzero(label == part)
            if share == 1:
                fresh[nodes], following[names] = names, 1
                names += 1
                continue
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[u] >= 0) & (place[v] >= 0)
            a, b = place[u[inside]], place[v[inside]]
            degree = np.maximum(np.bincount(a, minlength=len(nodes)), 1).astype(float)
            x = rng.standard_normal(len(nodes))
            for _ in range(80):
                x = 0.5 * x + 0.5 * np.bincount(a, x[b], len(nodes)) / degree
                x -= (x * degree).sum() / degree.sum()
                x /= max(np.abs(x).max(), 1e-300)
            left = share // 2
            cut = round(len(nodes) * left / share)
            first = nodes[np.argsort(x, kind="stable")[:cut]]
            fresh[nodes] = names + 1
            fresh[first] = names
            following[names], following[names + 1] = left, share - left
            names += 2
        label, sizes = fresh, following
    most = math.ceil(n / parts * 1.05)
    for _ in range(10):
        votes = np.zeros((n, parts))
        np.add.at(votes, (u, label[v]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        movers = np.flatnonzero(gain > 0)
        held = np.bincount(label, minlength=parts)
        moved = 0
        for i in movers[np.argsort(-gain[movers], kind="stable")][: len(movers) // 2 + 1]:
            if held[best[i]] < most:
                held[label[i]] -= 1
                held[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


def train_router(x: np.ndarray, target: np.ndarray, params: NeighbourParams, rng: np.random.Generator) -> Router:
    """Softmax network with one hidden layer, fitted to the partitions of each vector's neighbours (Adam)."""
    scale = 1 / max(float(np.sqrt((x * x).mean())), 1e-12)
    d, p, h = x.shape[1], target.shape[1], params.hidden
    weights = [rng.standard_normal((d, h)) * math.sqrt(2 / d), np.zeros(h), rng.standard_normal((h, p)) * math.sqrt(1 / h), np.zeros(p)]
    m, v, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(params.epochs):
        order = rng.permutation(len(x))
        rate = 0.004 * (1 - epoch / params.epochs) + 0.0002
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            a = x[rows] * scale
            hidden = np.maximum(a @ weights[0] + weights[1], 0)
            z = hidden @ weights[2] + weights[3]
            z = np.exp(z - z.max(1, keepdims=True))
            off = (z / z.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = (off @ weights[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((a.T @ back, back.sum(0), hidden.T @ off, off.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                weights[i] = weights[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(scale, [(weights[0], weights[1]), (weights[2], weights[3])], p)


def fit_router(points: np.ndarray, held: np.ndarray, params: NeighbourParams) -> Router:
    """Graph, partitions and network from ``points``; the number of probes from the ``held`` vectors."""
    rng = np.random.default_rng(params.seed)
    parts = max(1, min(params.partitions, len(points) // 64))
    if parts == 1 or not len(held):
        dim = points.shape[1]
        return Router(1.0, [(np.zeros((dim, 1)), np.zeros(1)), (np.zeros((1, 1)), np.zeros(1))], 1)
    degree = min(params.graph_degree, len(points) - 1)
    graph = nearest(points, points, degree, skip_own=True)
    label = balanced_parts(graph, parts, rng)
    target = np.zeros((len(points), parts))
    np.add.at(target, (np.repeat(np.arange(len(points)), degree), label[graph].ravel()), 1 / degree)
    target[np.arange(len(points)), label] += 0.5
    target /= target.sum(1, keepdims=True)
    router = train_router(points, target, params, rng)
    home = router.ranked(points)[:, 0]
    k = min(params.k, len(points))
    true = home[nearest(held, points, k)]
    ranked = router.ranked(held)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(parts)[None, :].repeat(len(held), 0), 1)
    visits = np.take_along_axis(place, true, 1)  # how many partitions come before each neighbour's own
    for probes in range(1, parts + 1):
        if (visits < probes).mean() >= params.target_recall:
            break
    router.probes = probes
    return router


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part: id not null, vector neither null nor zero,
    every component finite, of length ``dim`` (by default the most frequent length, of equally frequent ones the longest)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & good & F.exists("embedding", lambda x: x != 0)
    )
    if dim is not None:
        return rows.filter(F.size("embedding") == dim)
    lengths = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = lengths[0]["dim"] if lengths else 0
    return rows.filter(F.size("embedding") == dim)


def search(vectors: DataFrame, queries: DataFrame, params: NeighbourParams = NeighbourParams()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors of largest inner product found for every query.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``. A bounded sample of the vectors gives a neighbour
    graph, which is split into balanced partitions; a network learns to tell which partitions hold a vector's
    neighbours. Every vector is filed under its likeliest partition, every query visits its likeliest ones, and
    the products there are taken exactly, in double precision. Ranks go by score, ties by vec_id.

    Partitions are cut into blocks of vectors and of queries, dealt by hash, so that a partition with a third of
    all vectors becomes more tasks, not a longer one; each pair of blocks gives the best ``k`` of each
    query, and these are merged. Vectors that are null, zero, of another length or not finite take no
    part, nor do null ids; a query's own id is no candidate; rows repeating an id and a vector
    count once, in the sample too, and an id with several vectors takes one place, by the best of them. Empty tables give an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    points = usable(vectors).dropDuplicates(["vec_id", "embedding"])  # copies would fill the sample and the best places
    drawn = points.orderBy(F.xxhash64("vec_id", F.lit(params.seed)), "vec_id").limit(params.sample + params.probe_sample).collect()
    sample = np.array([r["embedding"] for r in drawn], np.float64)
    result = "query_id long, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = sample.shape[1]
    held = min(params.probe_sample, len(sample) // 10)
    router = fit_router(sample[held:], sample[:held], params)
    shared = spark.sparkContext.broadcast(router)  # two small matrices

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared.value
        for batch in batches:
            if batch.num_rows:
                ranked = router.ranked(_matrix(batch.column("embedding"), dim))[:, : router.probes].astype(np.int32)
                parts = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, ranked.size + 1, ranked.shape[1], dtype=np.int32)), pa.array(ranked.ravel())
                )
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), parts], ["vec_id", "embedding", "parts"])

    routed_type = "vec_id long, embedding array<double>, parts array<int>"
    filed = points.mapInArrow(route, routed_type).select("vec_id", "embedding", F.col("parts")[0].alias("part"))
    asking = usable(queries, dim).mapInArrow(route, routed_type).select(
        F.col("vec_id").alias("query_id"), "embedding", F.explode("parts").alias("part")
    )
    # one row per partition
    blocks = filed.groupBy("part").agg(F.ceil(F.count("*") / params.vector_block).alias("v_blocks")).join(
        asking.groupBy("part").agg(F.ceil(F.count("*") / params.query_block).alias("q_blocks")), "part"
    )
    counted = [tuple(r) for r in blocks.collect()]

    def sizes() -> DataFrame:  # a frame of its own for either side
        return F.broadcast(spark.createDataFrame(counted, "part int, v_blocks long, q_blocks long"))

    def numbers(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    left = filed.join(sizes(), "part").withColumn("v", F.pmod(F.xxhash64("vec_id"), "v_blocks")).withColumn("q", numbers("q_blocks"))
    right = asking.join(sizes(), "part").withColumn("q", F.pmod(F.xxhash64("query_id"), "q_blocks")).withColumn("v", numbers("v_blocks"))

    def best(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if block.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        block = block.sort_values("vec_id", kind="stable")
        ids = block["vec_id"].to_numpy()
        x, q = np.stack(block["embedding"].to_numpy()), np.stack(asked["embedding"].to_numpy())
        firsts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))  # an id with several vectors counts by its best one
        out = []
        for at in range(0, len(q), 256):
            rough = q[at : at + 256] @ x.T
            for i, query_id in enumerate(asked["query_id"].to_numpy()[at : at + 256]):
                s = rough[i]
                s[ids == query_id] = -np.inf
                top = np.maximum.reduceat(s, firsts) if len(firsts) < len(s) else s
                k = min(params.k, len(top))
                least = np.partition(top, len(top) - k)[len(top) - k]
                # products are summed alike for equal vectors, so that their ties are exact
                near = np.flatnonzero((s >= least - 1e-9 * max(1.0, abs(least))) & (s > -np.inf))
                exact = (x[near] * q[at + i]).sum(1)
                order = np.lexsort((ids[near], -exact))
                order = order[np.sort(np.unique(ids[near][order], return_index=True)[1])][:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[near][order], "score": exact[order]}, columns=columns))
        return pd.concat(out)

    keys = ["part", "v", "q"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda a, b: best(a, b), result)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= params.k).select("query_id", "rank", "vec_id", "score")
