"""Near-duplicate embeddings by an inverted multi-index: a product grid of two codebooks, visited cell by cell."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import connected_components
from .vectors import block_counts, dealt, finite, matrix, numbers


@dataclass(frozen=True)
class MultiIndexParams:
    """Vectors link at a cosine of ``cosine`` or more.

    The codebooks are fitted on the ``sample`` vectors of smallest hash (fewer long ones: about
    ``sample_values`` components in all); every vector is filed. A cell of the grid holds about ``cell``
    vectors, as far as ``most_words`` words a codebook allow. A vector visits cells in the order of their distance until
    ``target_recall`` of the partners at exactly the threshold, in random directions, would lie behind it; nearer
    partners are found more surely. 1.0 visits every cell that can hold a partner at all. ``bucket`` and ``query_block``
    bound the rows of a task.
    """

    cosine: float = 0.95
    target_recall: float = 0.999
    sample: int = 20_000
    sample_values: int = 8_000_000
    cell: int = 16
    most_words: int = 1024
    rounds: int = 12
    bucket: int = 4096
    query_block: int = 4096
    seed: int = 23


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by a power of two first, so that no square overflows or vanishes."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0))
    x = np.ldexp(x, -exponent[:, None])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows and centres."""
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * x @ centres.T, 0)


def codebook(x: np.ndarray, words: int, params: MultiIndexParams, rng: np.random.Generator) -> np.ndarray:
    """``words`` centres by Lloyd's rounds; a centre without members moves to the row farthest from its own."""
    centres = x[np.sort(rng.choice(len(x), words, replace=False))].copy()
    for _ in range(params.rounds):
        away = squared(x, centres)
        own = away.argmin(1)
        counts = np.bincount(own, minlength=words)
        totals = np.stack([np.bincount(own, column, words) for column in x.T], axis=1) if x.shape[1] else np.zeros((words, 0))
        centres = totals / np.maximum(counts, 1)[:, None]
        lost = np.flatnonzero(counts == 0)
        if len(lost):
            centres[lost] = x[np.argsort(-away.min(1), kind="stable")[: len(lost)]]
    return centres


@dataclass
class MultiIndex:
    """The two codebooks for vectors of one length, and how far a vector's visits go."""

    centres: tuple[np.ndarray, np.ndarray]
    limit: float = np.inf

    @property
    def words(self) -> int:
        return len(self.centres[0])

    def costs(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half, the squared distance that a row has at least from the region of every word: from the
        hyperplane between that word and its own."""
        cut, out = x.shape[1] // 2, []
        for half, centres in zip((x[:, :cut], x[:, cut:]), self.centres, strict=True):
            away = squared(half, centres)
            own = away.argmin(1)
            between = np.sqrt(squared(centres, centres))[own]
            beyond = away - away[np.arange(len(x)), own][:, None]
            out.append(np.square(np.where(between > 0, beyond / np.where(between > 0, 2 * between, 1), 0)))
        return out

    def cells(self, x: np.ndarray) -> np.ndarray:
        cut = x.shape[1] // 2
        first, second = (squared(h, c).argmin(1) for h, c in zip((x[:, :cut], x[:, cut:]), self.centres, strict=True))
        return first * self.words + second

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell of every visit, nearest cells first.

        Both halves' words stand in ascending order of cost, so the cells up to the limit form a staircase: the
        traversal of the two sequences goes up to the limit and takes, for each word of the first half, a prefix of the second's.
        """
        first, second = self.costs(x)
        orders = np.argsort(first, axis=1, kind="stable"), np.argsort(second, axis=1, kind="stable")
        first, second = (np.take_along_axis(c, o, 1) for c, o in zip((first, second), orders, strict=True))
        rows, cells, sums = [], [], []
        for i in range(self.words):  # the i-th nearest word of the first half, for all rows that still go there
            on = np.flatnonzero(first[:, i] <= self.limit)
            if not len(on):
                break
            reach = (second[on] <= self.limit - first[on, i][:, None]).sum(1)
            row = np.repeat(on, reach)
            place = np.arange(len(row)) - np.repeat(np.cumsum(reach) - reach, reach)
            rows.append(row)
            cells.append(orders[0][row, i] * self.words + orders[1][row, place])
            sums.append(first[row, i] + second[row, place])
        row, cell, total = (np.concatenate(a) for a in (rows, cells, sums))
        order = np.lexsort((total, row))
        return row[order], cell[order]


def fit(points: np.ndarray, count: int, params: MultiIndexParams) -> MultiIndex:
    """Codebooks and visiting limit for ``count`` vectors of which ``points`` (of length 1) are a sample."""
    rng = np.random.default_rng(params.seed)
    wanted = max(1, round(np.sqrt(count / params.cell)))
    words = max(1, min(wanted, params.most_words, len(points) // 16))
    cut = points.shape[1] // 2
    index = MultiIndex(tuple(codebook(half, words, params, rng) for half in (points[:, :cut], points[:, cut:])))
    reach = 2 - 2 * params.cosine  # the squared distance of a partner at the threshold
    index.limit = reach
    if params.target_recall < 1 and points.shape[1] > 1:
        asked = points[rng.permutation(len(points))[:4096]]
        aside = rng.standard_normal(asked.shape)
        aside -= (aside * asked).sum(1, keepdims=True) * asked
        partners = params.cosine * asked + np.sqrt(1 - params.cosine**2) * unit(aside)
        cells, costs = index.cells(partners), index.costs(asked)
        at = np.arange(len(asked))
        index.limit = min(reach, float(np.quantile(costs[0][at, cells // words] + costs[1][at, cells % words], params.target_recall)))
    return index


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node reachable from each of ``n`` nodes over the links ``a, b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, label[a], low)
        np.minimum.at(fresh, label[b], low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def near(x: np.ndarray, y: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs whose cosine reaches the threshold, block by block."""
    for at in range(0, len(x), 256):
        s = x[at : at + 256] @ y.T
        i, j = np.nonzero(s >= cosine - 1e-9)
        doubt = s[i, j] < cosine + 1e-9  # sums in another order might say otherwise: these are taken alike for all
        good = ~doubt
        good[doubt] = (x[at + i[doubt]] * y[j[doubt]]).sum(1) >= cosine
        yield at + i[good], j[good]


def embedding_duplicates(vectors: DataFrame, params: MultiIndexParams = MultiIndexParams()) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id``, ``embedding``): ``vec_id, n_links, component_id, kept``.

    Vectors link if their cosine, in double precision, reaches the threshold; ``n_links`` counts the other vectors that one is
    linked with directly, ``component_id`` is the smallest vec_id reachable.

    Equal vectors are one class, carried by its smallest id and weighed by its size. Two codebooks, one for either half of
    the vectors, make a grid; a class is filed under the cell of its two nearest words. From there it visits cells in
    the order of their distance, those numbered before its own excepted, whose members visit it instead. What a visit meets
    is compared whole. Cells of a row of the grid are put together to buckets of bounded size, a larger cell is cut into blocks, and a
    task gets one block of a bucket with one block of its visitors. It hands on counts and a spanning forest of the
    links, never the pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors of different lengths
    never link. Rows that repeat an id and vector count once and give equal results; an id with several vectors stands
    with one of them, by hash. A row without id takes no part, is kept and has no component. An empty table gives an empty result. Other
    columns are ignored.
    """
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"  # then floats hold all of it
    kind = "array<float>" if single else "array<double>"
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    prints = [F.xxhash64(F.lit(s), F.size("embedding"), "embedding").alias(n) for s, n in ((1, "print_a"), (2, "print_b"))]
    able = given.filter(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite("embedding") & F.exists("embedding", lambda x: x != 0)
    ).select("vec_id", *prints, "embedding")
    ids = able.groupBy("vec_id").agg(F.min(F.struct("print_a", "print_b")).alias("p")).select("vec_id", "p.*")
    classes = cut_lineage(ids.groupBy("print_a", "print_b").agg(F.min("vec_id").alias("first"), F.count("*").alias("n")))
    held = able.join(classes.withColumnRenamed("first", "vec_id"), ["vec_id", "print_a", "print_b"])
    held = cut_lineage(held.groupBy("vec_id").agg(F.first("n").alias("n"), F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding")))

    counted = {r["dim"]: r["count"] for r in held.groupBy("dim").count().collect()}  # a row per length
    mean = sum(dim * n for dim, n in counted.items()) / max(sum(counted.values()), 1)
    bound = min(params.sample, int(params.sample_values // max(mean, 1)))
    drawn = held.select("dim", "embedding").orderBy(F.xxhash64("vec_id", F.lit(params.seed)), "vec_id").limit(bound).toArrow()
    lengths = numbers(drawn, "dim")
    indexes = {}
    for dim, count in counted.items():
        points = drawn.filter(pa.array(lengths == dim))
        centre = np.zeros((1, dim))
        one_cell = MultiIndex((centre[:, : dim // 2], centre[:, dim // 2 :]))  # of a length too rare for the sample
        indexes[dim] = fit(unit(matrix(points, "embedding", dim)), count, params) if len(points) else one_cell
    together = {dim: max(1, min(m.words, round(params.bucket * m.words**2 / counted[dim]))) for dim, m in indexes.items()}

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = numbers(batch, "dim")
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                index, step = indexes[dim], together[dim]
                for at in range(0, part.num_rows, 512):
                    piece = part.slice(at, 512)
                    x = unit(matrix(piece, "embedding", dim))
                    own = index.cells(x)
                    row, cell = index.visits(x)
                    later = cell > own[row]
                    row, cell = np.concatenate([np.arange(len(x)), row[later]]), np.concatenate([own, cell[later]])
                    # a bucket: some neighbouring words of the second half under one word of the first
                    per_row = -(-index.words // step)
                    bucket = cell // index.words * per_row + cell % index.words // step
                    order = np.lexsort((cell, bucket, row))
                    row, cell, bucket = row[order], cell[order], bucket[order]
                    starts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0))
                    lists = pa.ListArray.from_arrays(np.append(starts, len(cell)).astype(np.int32), pa.array(cell.astype(np.int32)))
                    homes = own // index.words * per_row + own % index.words // step
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("vec_id").take(pa.array(row[starts])), piece.column("n").take(pa.array(row[starts])),
                            piece.column("embedding").take(pa.array(row[starts])), pa.array(np.full(len(starts), dim, np.int32)),
                            pa.array(own[row[starts]].astype(np.int32)), pa.array(bucket[starts].astype(np.int32)), lists,
                            pa.array(bucket[starts] == homes[row[starts]]),
                        ],
                        ["vec_id", "n", "embedding", "dim", "cell", "bucket", "visited", "home"],
                    )

    filed = cut_lineage(held.mapInArrow(
        file, f"vec_id long, n long, embedding {kind}, dim int, cell int, bucket int, visited array<int>, home boolean"
    ))
    keys = ["dim", "bucket"]
    members = filed.filter("home").drop("visited", "home")
    asking = filed.drop("home")
    counts = cut_lineage(block_counts(members, asking, keys, params.bucket, params.query_block))

    def compare(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if len(block) and len(asked):
            dim = block.column("dim")[0].as_py()
            x, q = unit(matrix(block, "embedding", dim)), unit(matrix(asked, "embedding", dim))
            ids, own_ids = numbers(block, "vec_id"), numbers(asked, "vec_id")
            cells, own_cells = numbers(block, "cell"), numbers(asked, "cell")
            visited = asked.column("visited").combine_chunks()
            visitor = np.repeat(np.arange(len(asked)), np.diff(visited.offsets.to_numpy()))
            goal = visited.flatten().to_numpy()
            by_cell, by_goal = np.argsort(cells, kind="stable"), np.argsort(goal, kind="stable")
            names, place = np.unique(np.concatenate([own_ids, ids]), return_inverse=True)
            at_own, at_here = place[: len(own_ids)], place[len(own_ids) :]
            weight, own_weight = numbers(block, "n"), numbers(asked, "n")
            first, linked = np.arange(len(names)), np.zeros(len(names))
            for cell in np.intersect1d(cells, goal):
                here = by_cell[slice(*np.searchsorted(cells[by_cell], [cell, cell + 1]))]
                guests = visitor[by_goal[slice(*np.searchsorted(goal[by_goal], [cell, cell + 1]))]]
                for i, j in near(q[guests], x[here], params.cosine):  # pairs of one block at a time become counts and roots
                    a, b = guests[i], here[j]
                    once = (own_cells[a] != cell) | (own_ids[a] < ids[b])  # within a cell, each pair from its smaller id
                    a, b = a[once], b[once]
                    if len(a):
                        linked += np.bincount(at_own[a], weight[b], len(names)) + np.bincount(at_here[b], own_weight[a], len(names))
                        first = roots(first[at_own[a]], first[at_here[b]], len(names))[first]
            has = linked > 0
            out = [names[has], names[first[has]], linked[has].astype(np.int64)]
        return pa.table(out or [np.empty(0, np.int64)] * 3, ["id", "root", "linked"])

    by = [*keys, "i", "j"]
    left = dealt(members, counts, keys, ["vec_id"], True).groupBy(*by)
    met = left.cogroup(dealt(asking, counts, keys, ["vec_id"], False).groupBy(*by))
    found = cut_lineage(met.applyInArrow(compare, "id long, root long, linked long"))
    links = found.groupBy("id").agg(F.sum("linked").alias("linked"))
    components = connected_components(found.select("id", "root").filter("id != root").distinct(), "id", "root")

    named = classes.join(links.withColumnRenamed("id", "first"), "first", "left").join(
        components.withColumnRenamed("id", "first"), "first", "left"
    ).select("print_a", "print_b", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), F.coalesce("component", "first").alias("component"))
    by_id = ids.join(named, ["print_a", "print_b"]).select("vec_id", "links", "component")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return given.select("vec_id").join(by_id, "vec_id", "left").select(
        "vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
