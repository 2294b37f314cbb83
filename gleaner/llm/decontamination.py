"""Benchmark items inside documents: size-partitioned MinHash containment search, exact confirmation."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ContaminationParams:
    """``containment`` is a percentage of an item's distinct word shingles.

    Items of similar size form a partition: each covers sizes up to ``growth`` times its smallest.
    ``item_block`` bounds the items whose signatures travel to the tasks at a time.
    """

    shingle: int = 5
    containment: int = 80
    growth: float = 2.0
    samples: int = 128
    item_block: int = 20_000
    seed: int = 11


WORD_CHUNK = 1 << 15
STRIPS = 1 << 12  # strips whose samples are held together


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, anything but ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(tokens: list[bytes], size: int) -> np.ndarray:
    """A 64-bit fingerprint for every run of ``size`` words, in order; all words as one run if there are fewer."""
    if not tokens:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(size, len(tokens))
    total = np.full(len(tokens) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + each[i : len(each) - width + 1 + i])
    return total


@dataclass
class SizePartition:
    """Items with ``smallest`` to ``largest`` distinct shingles. Documents are searched in windows of twice
    ``largest`` starting every ``largest`` shingles, so that wherever an item stands, a window holds it whole."""

    largest: int
    items: list[int] = field(default_factory=list)


@dataclass
class Signatures:
    partitions: list[SizePartition]
    shingles: list[frozenset]
    ids: list[int]
    lookup: list[dict[int, list[int]]]  # by partition: sample value -> items
    filters: list[np.ndarray]  # by partition: which low bits occur among its sample values


FILTER_BITS = 20


def _samples(values: np.ndarray, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The sample (bin) and the order within it of every fingerprint: one permutation, ``count`` bins."""
    order = _mixed(values ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (order & np.uint64(count - 1)).astype(np.int64), order | np.uint64(count - 1)


def signatures(items: list[tuple[int, str]], params: ContaminationParams) -> Signatures:
    """Partition the items by size and note each one's MinHash samples."""
    sets = [frozenset(zip_runs(words(text), params.shingle)) for _, text in items]
    hashes = [np.unique(shingle_hashes(words(text), params.shingle)) for _, text in items]
    order = sorted((i for i in range(len(items)) if len(hashes[i])), key=lambda i: len(hashes[i]))
    out = Signatures([], sets, [i for i, _ in items], [], [])
    smallest = 0
    for i in order:
        size = len(hashes[i])
        if not out.partitions or size > max(smallest * params.growth, smallest + 1):
            out.partitions.append(SizePartition(size))
            out.lookup.append(defaultdict(list))
            out.filters.append(np.zeros(1 << FILTER_BITS, bool))
            smallest = size
        part = out.partitions[-1]
        part.largest = max(part.largest, size)
        part.items.append(i)
        bins, values = _samples(hashes[i], params.samples, params.seed)
        least = np.full(params.samples, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, bins, values)
        for b in np.flatnonzero(least != np.iinfo(np.uint64).max):
            key = int(_keyed(least[b : b + 1], np.array([b]))[0])
            out.lookup[-1][key].append(i)
            out.filters[-1][key & ((1 << FILTER_BITS) - 1)] = True
    out.lookup = [dict(x) for x in out.lookup]
    return out


def zip_runs(tokens: list[bytes], size: int) -> Iterator[bytes]:
    width = min(size, len(tokens))
    return (b" ".join(tokens[i : i + width]) for i in range(len(tokens) - width + 1)) if tokens else iter(())


def _keyed(values: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return _mixed(values + bins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def candidates(hashes: list[np.ndarray], found: Signatures, params: ContaminationParams) -> dict[int, set[int]]:
    """By document (its place in ``hashes``): the items that share a MinHash sample with one of its windows."""
    out: dict[int, set[int]] = defaultdict(set)
    lengths = np.array([len(h) for h in hashes])
    if not lengths.sum():
        return out
    bins, values = _samples(np.concatenate(hashes), params.samples, params.seed)
    doc = np.repeat(np.arange(len(hashes)), lengths)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    for part, lookup, has in zip(found.partitions, found.lookup, found.filters, strict=True):
        stride = max(part.largest, 1)
        strips = -(-lengths // stride)  # windows are two strips wide; a document's last strip may be short
        first = np.cumsum(strips) - strips
        total, width = int(strips.sum()), params.samples
        strip = first[doc] + place // stride  # ascending
        owner = np.repeat(np.arange(len(hashes)), strips)
        for at in range(0, total, STRIPS):  # some strips at a time, and the one that the last window reaches into
            to = min(at + STRIPS + 1, total)
            here = slice(*np.searchsorted(strip, [at, to]))
            least = np.full((to - at) * width, np.iinfo(np.uint64).max, np.uint64)
            # the smallest value of every bin in every strip
            np.minimum.at(least, (strip[here] - at) * width + bins[here], values[here])
            least = least.reshape(to - at, width)
            same = owner[at + 1 : to] == owner[at : to - 1]
            joined = least[: min(STRIPS, to - at)].copy()
            pairs = np.flatnonzero(same)
            joined[pairs] = np.minimum(least[pairs], least[pairs + 1])
            keys = _keyed(joined, np.broadcast_to(np.arange(width), joined.shape))
            window, _ = hits = np.nonzero(has[(keys & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            for w, key in zip(window.tolist(), keys[hits].tolist(), strict=True):
                if key in lookup:
                    out[int(owner[at + w])].update(lookup[key])
    return out


def matches(texts: Iterator[str | None], found: Signatures, params: ContaminationParams) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """By text, in order: its place and the items it holds, as ``(item, shared, size)``."""

    def checked(first: int, tokens: list[list[bytes]]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        maybe = candidates([shingle_hashes(t, params.shingle) for t in tokens], found, params)
        for i, words_of in enumerate(tokens):
            held = []
            if i in maybe:
                asked = frozenset().union(*(found.shingles[item] for item in maybe[i]))
                runs = asked.intersection(zip_runs(words_of, params.shingle))  # no more of a long text than the items hold
                for item in sorted(maybe[i]):
                    wanted = found.shingles[item]
                    common = len(wanted & runs)
                    if 100 * common >= params.containment * len(wanted):
                        held.append((item, common, len(wanted)))
            yield first + i, held

    tokens: list[list[bytes]] = []
    first = size = 0
    for text in texts:
        tokens.append(words(text))
        size += len(tokens[-1])
        if size >= WORD_CHUNK:  # windows of many short texts are made at once, a long text alone
            yield from checked(first, tokens)
            first, size, tokens = first + len(tokens), 0, []
    yield from checked(first, tokens)


def _blocks(benchmark: DataFrame, params: ContaminationParams) -> Iterator[list[tuple[int, str]]]:
    """The different items, in blocks of about ``item_block`` dealt by hash; each is collected only to be sent out."""
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    wanted = wanted.filter("item_id is not null and text is not null").dropDuplicates()
    blocks = max(1, math.ceil(wanted.count() / params.item_block))
    for b in range(blocks):
        block = wanted if blocks == 1 else wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield sorted((r["item_id"], r["text"]) for r in block.collect())


def contaminated(docs: DataFrame, benchmark: DataFrame, params: ContaminationParams = ContaminationParams()) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles``: items of which a document holds at least ``containment`` percent.

    An item is the set of its distinct word shingles (A-Z lower-cased, words between ASCII white space; an item
    with fewer words is one run of all of them, which a document matches only if that is its whole text). Documents
    keep their whole length: every size partition of the items searches windows of its own size, so that
    the similarity of an item and a window never sinks with the document's length. Sharing one MinHash
    sample makes a candidate; it counts after its shingles are looked up, as words, in the whole document.

    Documents are neither shuffled nor compared with each other. The items go to the tasks in blocks of at
    most ``item_block``; a larger benchmark is searched block after block. Null or empty texts on either side
    match nothing, rows with a null id on either side are left out, equal items are each reported, repeated
    documents give repeated rows. Other columns are ignored; empty tables give an empty result.
    """
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(items: list[tuple[int, str]]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(signatures(items, params))  # about item_block items

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = shared.value
            for batch in batches:
                ids = batch.column("doc_id")
                out = [
                    (ids[at].as_py(), found.ids[item], common, size)
                    for at, held in matches((t.as_py() for t in batch.column("text")), found, params)
                    for item, common, size in held
                ]
                columns = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "shared", "item_shingles"]
                )

        return rows.mapInArrow(run, "doc_id long, item_id long, shared long, item_shingles long")

    return reduce(DataFrame.unionByName, [search(items) for items in _blocks(benchmark, params)])


def clean_documents(docs: DataFrame, benchmark: DataFrame, params: ContaminationParams = ContaminationParams()) -> DataFrame:
    """The documents, all columns, that hold no benchmark item; see ``contaminated``. Each text is judged in
    the task that reads it, so nothing is shuffled; rows with a null doc_id are judged like others."""

    def without(rows: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(signatures(items, params))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = dict(matches((t.as_py() for t in batch.column("text")), shared.value, params))
                yield batch.filter(pa.array([not held[at] for at in range(batch.num_rows)], pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    return reduce(without, _blocks(benchmark, params), docs)
