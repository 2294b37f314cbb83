"""Near-duplicate documents: banded MinHash candidates, odd-sketch estimates, exact confirmation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import connected_components, ordered_pair, unresolved


@dataclass(frozen=True)
class NearDuplicateParams:
    """``similarity`` is a percentage: documents link if 100 * intersection >= similarity * union.

    With bands of ``rows`` minima a pair at the threshold is missed with probability
    (1 - s**rows)**bands, 8e-6 for the defaults at s = 0.85; more similar pairs less often. The odd
    sketch drops a candidate only below ``similarity - slack``, over five standard errors away.
    """

    shingle: int = 3
    similarity: int = 85
    bands: int = 20
    rows: int = 5
    sketch_bits: int = 512
    slack: float = 0.20
    hub_rounds: int = 1
    block: int = 1024
    block_shingles: int = 1 << 21
    seed: int = 7


CHUNK = 1 << 15  # shingles hashed at a time: the working set stays in the processor's cache


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit fingerprints of the distinct word shingles; see ``near_duplicates``."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + each[i : len(each) - width + 1 + i])
    return np.unique(total)


def _permutations(params: NearDuplicateParams) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(params.seed)
    count = params.bands * params.rows
    multiply = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return multiply, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def minima(sets: list[np.ndarray], params: NearDuplicateParams) -> np.ndarray:
    """MinHash samples, one row per non-empty set."""
    multiply, add = _permutations(params)
    out = np.full((len(sets), len(multiply)), np.iinfo(np.uint64).max, np.uint64)
    first = 0
    while first < len(sets):
        last, held = first, 0  # as many sets as fill a chunk; a longer set is hashed piece by piece
        while last < len(sets) and (last == first or held + len(sets[last]) <= CHUNK):
            held += len(sets[last])
            last += 1
        if held <= CHUNK:
            joined = np.concatenate(sets[first:last])
            starts = np.cumsum([0, *map(len, sets[first : last - 1])])
            for i in range(len(multiply)):
                out[first:last, i] = np.minimum.reduceat(joined * multiply[i] + add[i], starts)
        else:
            for at in range(0, held, CHUNK):
                piece = sets[first][at : at + CHUNK]
                for i in range(len(multiply)):
                    out[first, i] = min(out[first, i], (piece * multiply[i] + add[i]).min())
        first = last
    return out


def odd_sketches(mins: np.ndarray, params: NearDuplicateParams) -> np.ndarray:
    """Parity bitmaps of the samples, ``sketch_bits / 8`` bytes a row: sample i with value v flips one bit."""
    count, k = mins.shape
    bits = _mixed(mins ^ _mixed(np.arange(1, k + 1, dtype=np.uint64))) % np.uint64(params.sketch_bits)
    at = bits.astype(np.int64) + np.arange(count)[:, None] * params.sketch_bits
    flips = np.bincount(at.ravel(), minlength=count * params.sketch_bits) & 1
    return np.packbits(flips.astype(np.uint8).reshape(count, params.sketch_bits), axis=1)


def most_different_bits(params: NearDuplicateParams) -> int:
    """The largest XOR population count whose similarity estimate stays within the slack."""
    k, n = params.bands * params.rows, params.sketch_bits
    lowest = params.similarity / 100 - params.slack
    return math.ceil(n / 2 * (1 - math.exp(-4 * k * (1 - lowest) / n)))


def _total(shingles: np.ndarray) -> int | None:
    return int(np.add.reduce(_mixed(shingles)).view(np.int64)) if len(shingles) else None


def sketch(docs: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands, odd``; the last four are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingle_set(t.as_py(), params.shingle) for t in part.column(1)]
                full = [s for s in sets if len(s)]
                mins = minima(full, params) if full else np.empty((0, params.bands * params.rows), np.uint64)
                odd = odd_sketches(mins, params) if full else []
                keys = np.zeros((len(full), params.bands), np.uint64) + np.arange(params.bands, dtype=np.uint64)
                for r in range(params.rows):
                    keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + mins[:, r :: params.rows])
                place = np.cumsum([len(s) > 0 for s in sets]) - 1
                rows = [
                    (
                        len(s),
                        _total(s),
                        int(np.bitwise_xor.reduce(_mixed(s + np.uint64(77))).view(np.int64)) if len(s) else None,
                        keys[place[i]].view(np.int64) if len(s) else None,
                        odd[place[i]].tobytes() if len(s) else None,
                    )
                    for i, s in enumerate(sets)
                ]
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands", "odd"],
                )

    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, odd binary"
    return docs.mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """``doc_id, set_a, shingles``: the full set of each row, as bytes of sorted 64-bit fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingle_set(t.as_py(), params.shingle) for t in part.column(1)]
                columns = [pa.array([_total(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "set_a", "shingles"])

    return docs.mapInArrow(run, "doc_id long, set_a long, shingles binary")


def _linked(pairs: DataFrame, sets: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_of_a"), batch.column("set_of_b"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                least = params.similarity * max(len(s), len(t))
                if 100 * min(len(s), len(t)) < least:  # the sizes alone rule it out
                    keep.append(False)
                    continue
                common = len(s) + len(t) - len(np.union1d(s, t))
                keep.append(100 * common >= params.similarity * (len(s) + len(t) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of_a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_of_a"))
    of_b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_of_b"))
    return pairs.join(of_a, "a").join(of_b, "b").mapInArrow(run, "a long, b long")


def _different_bits(x: str, y: str, params: NearDuplicateParams) -> Column:
    """Population count of the XOR of two bitmaps, eight bytes at a time."""
    words = [
        F.bit_count(F.conv(F.hex(F.substring(x, at, 4)), 16, 10).cast("long").bitwiseXOR(
            F.conv(F.hex(F.substring(y, at, 4)), 16, 10).cast("long")))
        for at in range(1, params.sketch_bits // 8 + 1, 4)
    ]
    return sum(words[1:], words[0])


def _promising(pairs: DataFrame, classes: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """The distinct pairs whose odd sketches differ in few enough bits."""
    of_a = classes.select(F.col("doc_id").alias("a"), F.col("odd").alias("odd_a"), F.col("n_shingles").alias("n_a"))
    of_b = classes.select(F.col("doc_id").alias("b"), F.col("odd").alias("odd_b"), F.col("n_shingles").alias("n_b"))
    joined = pairs.distinct().join(of_a, "a").join(of_b, "b")
    sized = joined.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * params.similarity)
    return sized.filter(_different_bits("odd_a", "odd_b", params) <= most_different_bits(params)).select("a", "b")


def _met(members: DataFrame, payload: DataFrame, fields: list[str], params: NearDuplicateParams) -> DataFrame:
    """``band, key, left, right``: every block of a bucket's minor members with every block of all its members.

    ``members`` (band, key, doc_id, component, major) holds buckets that span several components, ``payload`` the columns ``fields`` and
    ``n_shingles`` by doc_id. Blocks are bounded in count and size.
    """
    # blocks are dealt on narrow rows; the fields join them last and travel once
    narrow = members.select("band", "key", "doc_id", "component", "major").join(payload.select("doc_id", "n_shingles"), "doc_id")

    def blocks(n: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(n / params.block), F.ceil(shingles / params.block_shingles))

    counts = narrow.groupBy("band", "key").agg(
        blocks(F.count("*"), F.sum("n_shingles")).alias("right_blocks"),
        blocks(F.count_if(~F.col("major")), F.sum(F.when(~F.col("major"), F.col("n_shingles")))).alias("left_blocks"),
    )
    sized = cut_lineage(narrow.drop("n_shingles").join(counts, ["band", "key"]))

    # members are dealt over blocks by their id; every block goes to each block of the other side
    def dealt(rows: DataFrame, own: str, place: str, others: str, other: str, left: bool) -> DataFrame:
        return rows.withColumn(place, F.pmod(F.xxhash64("doc_id"), own)).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))
        ).select("band", "key", "i", "j", "doc_id", "component", F.lit(left).alias("is_left"))

    sides = dealt(sized.filter(~F.col("major")), "left_blocks", "i", "right_blocks", "j", True).unionByName(
        dealt(sized, "right_blocks", "j", "left_blocks", "i", False)
    )
    row = F.struct("doc_id", "component", *fields)
    met = sides.join(payload.select("doc_id", *fields), "doc_id").groupBy("band", "key", "i", "j").agg(
        F.collect_list(F.when(F.col("is_left"), row)).alias("left"), F.collect_list(F.when(~F.col("is_left"), row)).alias("right")
    )
    return met.select("band", "key", "left", "right")


def _near_in_block(row: dict, sizes: np.ndarray, params: NearDuplicateParams) -> Iterator[tuple[int, np.ndarray]]:
    """For every document on the left, its place and those of the documents on the right that lie in other components, look
    similar enough by size and sketch, and share no earlier band."""
    left, right = row["left"], row["right"]
    limit = most_different_bits(params)
    odd = [np.frombuffer(b"".join(x["odd"] for x in side), np.uint8).reshape(len(side), -1) for side in (left, right)]
    bands = np.array([x["bands"] for x in right], np.int64)
    parts = np.array([x["component"] for x in right], np.int64)
    for i, x in enumerate(left):
        own = x["n_shingles"]
        near = (np.bitwise_count(odd[1] ^ odd[0][i]).sum(1) <= limit) & (parts != x["component"])
        near &= 100 * np.minimum(sizes, own) >= params.similarity * np.maximum(sizes, own)
        at_right = np.flatnonzero(near)
        if len(at_right):
            at_right = at_right[(bands[at_right] == np.array(x["bands"])).argmax(1) == row["band"]]
        if len(at_right):
            yield i, at_right


def _cross_links(members: DataFrame, payload: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """The links ``a, b`` between members of a bucket that lie in different components.

    Those outside a bucket's largest component meet all of its members, block by block: first by their sketches, which tells the few
    documents of a bucket that look similar at all; then these by their full sets, each pair in its first shared band only. A row leaves a
    task for every document that looks similar, then for every document and component that link, so that
    neither result grows with the pairs.
    """

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                sizes = np.array([x["n_shingles"] for x in row["right"]])
                found: set[int] = set()
                for i, at_right in _near_in_block(row, sizes, params):
                    found.add(row["left"][i]["doc_id"])
                    found.update(row["right"][j]["doc_id"] for j in at_right)
                if found:
                    n = len(found)
                    yield pa.RecordBatch.from_arrays([pa.array([row["band"]] * n, pa.int32()), pa.array([row["key"]] * n, pa.int64()), pa.array(sorted(found))], ["band", "key", "doc_id"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                left, right = row["left"], row["right"]
                parts = np.array([x["component"] for x in right], np.int64)
                sets = [np.frombuffer(x["shingles"], np.uint64) for x in right]
                sizes = np.array([len(s) for s in sets])
                found: list[tuple[int, int]] = []
                for i, at_right in _near_in_block(row, sizes, params):
                    own = np.frombuffer(left[i]["shingles"], np.uint64)
                    joined = np.concatenate([sets[j] for j in at_right])
                    place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
                    owner = np.repeat(np.arange(len(at_right)), sizes[at_right])
                    common = np.bincount(owner, own[place] == joined, len(at_right))
                    linked = at_right[100 * common >= params.similarity * (len(own) + sizes[at_right] - common)]
                    _, one_each = np.unique(parts[linked], return_index=True)
                    found += [(left[i]["doc_id"], right[j]["doc_id"]) for j in linked[one_each]]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([min(f) for f in found]), pa.array([max(f) for f in found])], ["a", "b"])

    looks = _met(members, payload, ["n_shingles", "odd", "bands"], params).mapInArrow(promising, "band int, key long, doc_id long")
    looks = cut_lineage(looks.distinct())
    few = cut_lineage(members.join(looks, ["band", "key", "doc_id"], "left_semi"))
    met = _met(few, payload, ["n_shingles", "odd", "bands", "shingles"], params)
    return met.mapInArrow(linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, params: NearDuplicateParams = NearDuplicateParams()) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id, n_shingles, component_id, kept``.

    A-Z are lower-cased, words are runs of anything but ASCII white space, and a document is the set of
    its distinct word shingles (all words as one if there are fewer). Documents link if their sets are similar
    enough; ``component_id`` is the smallest doc_id reachable over links.

    Documents of equal sets are one class, carried by its smallest id. MinHash bands bring classes together.
    Candidates pass the odd sketch's estimate and then the comparison of their full sets. Large
    buckets are not paired off: all members are first compared with one hub, then with hubs drawn at
    random from the bucket's largest component, and what is left outside it meets every member of other
    components, in blocks that are compared whole. So every pair that shares a band is either compared or already in one component.

    A null or empty text, or one without words, is an empty set, linked with nothing. Repeated rows give equal
    results; if a doc_id comes with several texts, the one of the smallest fingerprint stands for it in
    comparisons. A null ``doc_id`` takes no part and is kept. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = cut_lineage(sketch(rows, params))
    able = sketched.filter("doc_id is not null and n_shingles > 0")
    copies = able.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("first"))
    classes = cut_lineage(
        able.join(copies, ["set_a", "set_b"]).filter("doc_id = first")
        .groupBy("doc_id").agg(F.min_by(F.struct("n_shingles", "bands", "odd"), "set_a").alias("s")).select("doc_id", "s.*")
    )
    spread = classes.select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = spread.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("doc_id").alias("hub")).filter("n > 1")
    members = cut_lineage(spread.join(shared.drop("n"), ["band", "key"]))

    needed = members.select("doc_id").distinct()
    sets = shingle_sets(rows.join(needed, "doc_id", "left_semi"), params).filter("set_a is not null")
    sets = cut_lineage(sets.groupBy("doc_id").agg(F.min_by("shingles", "set_a").alias("shingles")))
    star = members.filter("doc_id != hub").select(*ordered_pair("doc_id", "hub"))
    links = cut_lineage(_linked(_promising(star, classes, params), sets, params))
    components = connected_components(links)
    for round_no in range(params.hub_rounds + 1):
        members = cut_lineage(unresolved(members, components, round_no))
        if members.isEmpty():  # every bucket lies in one component
            break
        if round_no < params.hub_rounds:
            pairs = _promising(members.filter("not major").select("doc_id", F.explode("hubs").alias("hub")).select(*ordered_pair("doc_id", "hub")), classes, params)
            found = cut_lineage(_linked(pairs, sets, params))
        else:
            found = cut_lineage(_cross_links(members, classes.join(sets, "doc_id"), params))
        if not found.isEmpty():
            links = links.unionByName(found)
            components = connected_components(links)

    named = copies.join(components.withColumnRenamed("id", "first"), "first", "left").select(
        "set_a", "set_b", F.coalesce("component", "first").alias("component")
    )
    return sketched.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.col("doc_id").eqNullSafe(F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))).alias("kept"),
    )
