"""Hard negatives by a vertical scan: dimensions column by column, bounds shrink the candidates until windows resolve."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .vectors import block_counts, dealt, matrix, numbers


@dataclass(frozen=True)
class HardNegativeParams:
    """A negative's score lies between ``low`` and ``high`` percent of a positive's. ``step`` dimensions are read
    between two looks at the bounds; ``few`` candidates left are scored at once. ``block`` and ``anchor_block``
    bound the rows that one task holds of either side."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    step: int = 8
    few: int = 32
    block: int = 4096
    anchor_block: int = 1024


LARGEST = float(2**62)  # of a vector's sum of squares: every inner product, whole or in part, fits a long
EXACT = float(2**53)  # below it doubles hold all these sums exactly


def whole_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, dim, values``: the rows that take part. Rows that repeat an id count once; of an id with
    different rows the first by label, then by vector, stands."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("values").cast("array<long>").alias("values"),
    )
    squares = F.aggregate("values", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    able = rows.filter("vec_id is not null and label is not null and values is not null").filter(
        F.forall("values", lambda x: x.isNotNull())
    ).filter(squares < LARGEST)
    firsts = able.groupBy("vec_id").agg(F.min(F.struct("label", "values")).alias("first"))
    return firsts.select("vec_id", "first.label", F.size("first.values").alias("dim"), "first.values")


def vertical_scan(
    anchor: np.ndarray, columns: np.ndarray, lows: np.ndarray, highs: np.ndarray, live: np.ndarray,
    keep: Callable[[np.ndarray, np.ndarray], np.ndarray], params: HardNegativeParams,
) -> tuple[np.ndarray, np.ndarray]:
    """The candidates that stay, and their exact products with ``anchor``.

    ``columns`` holds one row per dimension, read in descending magnitude of the anchor's components. What the unread
    dimensions can still add lies between the sums of their least and largest contributions, by each dimension's
    minimum and maximum; ``keep`` judges the candidates ``live`` by these lower and upper bounds.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.sort(np.stack([anchor * lows, anchor * highs]), axis=0)[:, order]
    rest = np.zeros((2, len(order) + 1), ends.dtype)
    rest[:, :-1] = np.cumsum(ends[:, ::-1], axis=1)[:, ::-1]
    score = np.zeros(len(live), columns.dtype)
    at = 0
    while at < len(order) and len(live):
        to = len(order) if len(live) <= params.few else min(at + params.step, len(order))
        read = order[at:to]
        part = columns[read] if len(live) == columns.shape[1] else columns[read[:, None], live]
        score += anchor[read] @ part
        at = to
        stays = keep(score + rest[0, at], score + rest[1, at])
        if not stays.all():
            live, score = live[stays], score[stays]
    return live, score


def best_bound(lower: np.ndarray, upper: np.ndarray, k: int) -> np.ndarray:
    """Who may still be among the ``k`` best."""
    if len(lower) <= k:
        return np.ones(len(lower), bool)
    return upper >= np.partition(lower, len(lower) - k)[len(lower) - k]


def in_windows(lower: np.ndarray, upper: np.ndarray, windows: set[tuple[int, int]], k: int) -> np.ndarray:
    """Who may still be among the ``k`` best of some window."""
    stays = np.zeros(len(lower), bool)
    for low, high in windows:
        near = (upper >= low) & (lower <= high)
        sure = (lower >= low) & (upper <= high)
        if np.count_nonzero(sure) > k:
            sure_of = lower[sure]
            near &= upper >= np.partition(sure_of, len(sure_of) - k)[len(sure_of) - k]
        stays |= near
    return stays


def _sides(block: pa.Table, asked: pa.Table) -> tuple[np.ndarray, ...]:
    """Columns (one row per dimension), their ends, ids and labels of a block, and the anchors' vectors."""
    dim = block.column("dim")[0].as_py()
    x, q = matrix(block, "values", dim, np.int64), matrix(asked, "values", dim, np.int64)
    largest = max((np.square(m.astype(np.float64)).sum(1).max() for m in (x, q)), default=0.0)
    if largest < EXACT:
        x, q = x.astype(np.float64), q.astype(np.float64)
    columns = np.ascontiguousarray(x.T)
    return columns, columns.min(1), columns.max(1), numbers(block, "vec_id"), numbers(block, "label"), q


def hard_negatives(vectors: DataFrame, anchors: DataFrame, params: HardNegativeParams = HardNegativeParams()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` and ``anchors`` have ``vec_id``, ``label`` and integer ``values``; a score is the inner product, higher
    scores come first, ties by smaller vec_id. An anchor's positives are its first ``positives`` other rows of the same
    label (all, if fewer). For each of them the first ``negatives`` rows of other labels follow whose score lies from
    ``low`` to ``high`` percent of the positive's (all, if fewer; a negative positive's window is empty).

    The vectors are dealt over blocks by the hash of their id, labels play no part in it, and each block meets each block
    of anchors in a task: once for the positives, once for the windows these open. A task hands on the best of its block
    only, and these are merged.

    Rows with a null id, label, vector or component take no part, nor do vectors whose sum of squares reaches 2**62
    (their products need not fit a long). Rows that repeat an id count once (see ``whole_rows``). Vectors of different
    lengths are never compared; empty vectors have the score 0. Anchors are a choice of rows of ``vectors`` by id.
    Empty tables give an empty result. Other columns are ignored.
    """
    rows = cut_lineage(whole_rows(vectors))
    asking = rows.join(anchors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    counts = cut_lineage(block_counts(rows, asking, ["dim"], params.block, params.anchor_block))  # a row per length
    keys = ["dim", "i", "j"]
    blocks = dealt(rows, counts, ["dim"], ["vec_id"], True).groupBy(*keys)

    def positives(block: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[np.ndarray] = []
        if len(block) and len(asked):
            columns, lows, highs, ids, labels, q = _sides(block, asked)
            for own, label, anchor in zip(numbers(asked, "vec_id"), numbers(asked, "label"), q, strict=True):
                live = np.flatnonzero((labels == label) & (ids != own))
                live, score = vertical_scan(anchor, columns, lows, highs, live, lambda a, b: best_bound(a, b, params.positives), params)
                first = np.lexsort((ids[live], -score))[: params.positives]
                found += [np.stack([np.full(len(first), own), ids[live[first]], score[first].astype(np.int64)])]
        out = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
        return pa.table(list(out), ["vec_id", "positive_id", "positive_score"])

    met = blocks.cogroup(dealt(asking, counts, ["dim"], ["vec_id"], False).groupBy(*keys))
    best = met.applyInArrow(positives, "vec_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = best.withColumn("n", place).filter(F.col("n") <= params.positives)
    opened = chosen.groupBy("vec_id").agg(  # some few per anchor
        F.collect_list("positive_id").alias("positive_ids"), F.collect_list("positive_score").alias("positive_scores")
    )
    windows = cut_lineage(asking.join(opened, "vec_id"))

    def negatives(block: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[np.ndarray] = []
        if len(block) and len(asked):
            columns, lows, highs, ids, labels, q = _sides(block, asked)
            sides = (numbers(asked, "vec_id"), numbers(asked, "label"), q, asked.column("positive_ids"), asked.column("positive_scores"))
            for own, label, anchor, positive_ids, scores in zip(*sides, strict=True):
                pairs = list(zip(positive_ids.as_py(), scores.as_py(), strict=True))
                ends = {s: (-(-params.low * s // 100), params.high * s // 100) for _, s in pairs}
                live = np.flatnonzero(labels != label)
                live, score = vertical_scan(
                    anchor, columns, lows, highs, live, lambda a, b: in_windows(a, b, set(ends.values()), params.negatives), params
                )
                order = np.lexsort((ids[live], -score))
                live, score = live[order], score[order].astype(np.int64)
                for positive, s in pairs:
                    first = np.flatnonzero((score >= ends[s][0]) & (score <= ends[s][1]))[: params.negatives]
                    n = len(first)
                    found.append(np.stack([np.full(n, own), np.full(n, positive), ids[live[first]], np.full(n, s), score[first]]))
        out = np.concatenate(found, axis=1) if found else np.empty((5, 0), np.int64)
        return pa.table(list(out), ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    met = blocks.cogroup(dealt(windows, counts, ["dim"], ["vec_id"], False).groupBy(*keys))
    near = met.applyInArrow(negatives, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= params.negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
