"""The prefix trie of conversations by truncation peeling: from the deepest level up, turn by turn."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from ..session import cut_lineage, ensure_checkpoint_dir

CHUNK = 1024  # turns of one conversation that a window holds together; members of one node in a piece of text
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_NAME = ["h1", "h2"]  # the name of a sequence of turns: two XOR sums over its turns and their places
_TURN = ["t1", "t2", "words"]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 1), the turn's two hashes ``t1, t2`` and its ``words``. Null turns come first; turns of one number go by role,
    then by the hash of their text. The order is cut into ranges, so that a conversation of any length is spread."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(11), role, text).alias("t1"), F.xxhash64(F.lit(12), role, text).alias("t2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    dense = numbered(cut_lineage(rows), ["conv_id", "turn", "role", "t1", "t2"], "n")
    starts = dense.groupBy("conv_id").agg(F.min("n").alias("start"))
    return dense.join(starts, "conv_id").select("conv_id", (F.col("n") - F.col("start") + 1).alias("place"), *_TURN)


def rebuilt(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: every conversation c takes the first h turns of conversation
    c - c % ``family`` (those there are), h being CRC-32 of c's decimal digits modulo ``heads``, and goes on with its own
    turns after its first h.

    The first result holds ``conv_id, depth`` (from 1) and the turn's hashes and words, the second all ``conv_id``
    with the number of their turns, ``length`` (turnless ones included).
    """
    own = cut_lineage(numbered_turns(turns))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    counts = own.groupBy("conv_id").agg(F.max("place").alias("turns"))
    convs = counts.select("conv_id", "turns", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    firsts = own.filter(F.col("place") < heads).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", *_TURN))).alias("firsts")  # fewer than ``heads`` of a conversation
    )
    known = cut_lineage(
        convs.join(firsts.withColumnRenamed("conv_id", "base"), "base", "left").select(
            "conv_id", "turns", "h", F.coalesce(F.filter("firsts", lambda t: t["place"] <= F.col("h")), F.array()).alias("head")
        )
    )
    head = known.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.place").alias("depth"), *[f"t.{c}" for c in _TURN])
    shift = known.select("conv_id", "h", (F.size("head") - F.col("h")).alias("shift"))
    tail = own.join(shift, "conv_id").filter("place > h").select("conv_id", (F.col("place") + F.col("shift")).alias("depth"), *_TURN)
    lengths = known.select("conv_id", (F.size("head") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("length"))
    return head.unionByName(tail), lengths


def named_prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, h1, h2, words, so_far``: every prefix by its name, the words of its last turn and of all its turns.

    A name is the XOR of hashes of place and turn, so it adds up over pieces of a conversation: windows run over
    pieces of bounded length, and one row per piece carries the sums across.
    """
    mixed = turns.withColumn("piece", F.floor((F.col("depth") - 1) / CHUNK)).withColumns(
        {"h1": F.xxhash64("depth", "t1", "t2"), "h2": F.xxhash64("t2", "depth", "t1")}
    )
    pieces = mixed.groupBy("conv_id", "piece").agg(*[F.bit_xor(h).alias(f"before_{h}") for h in _NAME], F.sum("words").alias("before_words"))
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.filter("piece > 0 or before_words is not null").select(
        "conv_id", "piece",
        *[F.coalesce(F.bit_xor(f"before_{h}").over(earlier), F.lit(0).cast("long")).alias(f"before_{h}") for h in _NAME],
        F.coalesce(F.sum("before_words").over(earlier), F.lit(0).cast("long")).alias("before_words"),
    )
    within = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    return mixed.join(carried, ["conv_id", "piece"]).select(
        "conv_id", "depth", *[F.bit_xor(h).over(within).bitwiseXOR(F.col(f"before_{h}")).alias(h) for h in _NAME],
        "words", (F.sum("words").over(within) + F.col("before_words")).alias("so_far"),
    )


def digests(ends: DataFrame) -> DataFrame:
    """``h1, h2, length, ends_sha256``: SHA-256 of the conv_ids that end at a node, ascending, joined by commas.

    The ids are cut into ranges over (node, id) and joined to pieces of text there; the pieces of a node then
    pass one after another through one hash, so that no task holds a node's members at once.
    """
    kind = "h1 long, h2 long, length long, first long, piece string"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        node, out = None, []

        def flush() -> None:
            if held:
                out.append((*node, held[0], ",".join(map(str, held))))
                held.clear()

        for batch in batches:
            for a, b, n, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b, n) != node or len(held) == CHUNK:
                    flush()
                    node = (a, b, n)
                held.append(conv)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema)
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema)

    names = ["h1", "h2", "length", "first", "piece"]
    schema = pa.schema([(n, pa.string() if n == "piece" else pa.int64()) for n in names])
    key = ["h1", "h2", "length"]
    ranged = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    pieces = cut_lineage(ranged.mapInArrow(join, kind))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for a, b, n, _, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b, n) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b, n), hashlib.sha256()
                state.update(piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*key, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, state.hexdigest())], [*key, "ends_sha256"])

    dealt = pieces.repartition(*key).sortWithinPartitions(*key, "first")
    return dealt.mapInArrow(digest, "h1 long, h2 long, length long, ends_sha256 string")


_NODE = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns`` has ``conv_id, depth`` (from 1, without gaps), two hashes of the turn ``t1, t2`` and its ``words``; ``lengths`` all
    conversations with their number of turns, ``length``. A node is a distinct sequence of first turns, from the
    root without any. A member is a conversation that starts with it; ``saved_tokens`` sums over a node's subtree (the node included) the
    members but one, times the words of the last turn.

    Equal conversations are one class from the start. Below the deepest node that a class shares with others its path
    has no branch, and its nodes are written down at once. Then the levels are peeled from the deepest shared
    one: classes that end or join there are merged with the nodes that survive from below, each merged node is written
    with its totals, gives up its last turn and goes on to the level above. Counts and sums are combined before
    each shuffle, and every level is a table in the checkpoint folder, so lost executors repeat one level only. The number of rounds is
    the depth of the deepest node shared by two different conversations.

    Rows with a null conv_id take no part. No conversation gives no node. Other columns are ignored.
    """
    spark = turns.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/trie-{uuid.uuid4().hex}"
    prefixes = cut_lineage(named_prefixes(turns))
    last = prefixes.select("conv_id", F.col("depth").alias("length"), *_NAME, "so_far")
    zero = F.lit(0).cast("long")
    full = lengths.filter("length > 0").select("conv_id", F.col("length").cast("long").alias("length")).join(last, ["conv_id", "length"])
    bare = lengths.filter("length = 0").select("conv_id", zero.alias("length"), *[zero.alias(n) for n in _NAME], zero.alias("so_far"))
    ends = cut_lineage(full.unionByName(bare))
    classes = ends.groupBy(*_NAME, "length").agg(F.min("conv_id").alias("first"), F.count("*").alias("n"), F.max("so_far").alias("total"))
    classes = cut_lineage(classes.join(digests(ends), [*_NAME, "length"]).withColumnRenamed("first", "conv_id"))
    most = classes.agg(F.sum("n")).first()[0]
    if not most:
        return spark.createDataFrame([], ", ".join(f"{c} long" for c in ["parent_conv_id", *_NODE[:-1]]) + ", ends_sha256 string").select(*_ORDER)

    # every class's prefixes, with how many conversations begin with them
    of_class = prefixes.join(classes.select("conv_id", "length", "n", "total", "ends_sha256"), "conv_id")
    # read from a checkpoint, so that the adaptive planner can split the rows of a very common first turn
    members = cut_lineage(prefixes.groupBy("depth", *_NAME).agg(F.count("*").alias("members")).filter("members > 1"))
    met = cut_lineage(of_class.join(members, ["depth", *_NAME], "left").withColumn("members", F.coalesce("members", F.lit(1))))
    shared = met.filter("members > n").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("depth", *_NAME, "words"))).alias("chain")  # down to the deepest shared node
    )
    alone = met.filter("members = n").join(shared.select("conv_id", F.size("chain").alias("shared")), "conv_id", "left")
    alone = alone.withColumn("shared", F.coalesce("shared", F.lit(0)).cast("long"))
    at_end = F.col("depth") == F.col("length")
    root = F.struct(zero.alias("depth"), *[zero.alias(n) for n in _NAME], zero.alias("words"))
    tails = alone.select(
        "depth", "conv_id", F.col("n").alias("n_convs"), F.when(at_end, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * (F.col("total") - F.col("so_far") + F.col("words"))).alias("saved_tokens"),
        F.when(at_end, F.col("ends_sha256")).alias("ends_sha256"), F.when(F.col("depth") - 1 > F.col("shared"), F.col("conv_id")).alias("parent_conv_id"),
    )
    # where a class enters the peeling: at its deepest shared node, as its end or as a child's only path
    below = met.filter("members = n").groupBy("conv_id").agg(F.sum("words").alias("words_below"))
    entries = classes.join(shared, "conv_id", "left").join(below, "conv_id", "left").select(
        F.concat(F.array(root), F.coalesce("chain", F.array().cast(shared.schema["chain"].dataType))).alias("chain"),
        "conv_id", F.col("n").alias("n_convs"),
        *[F.when(F.col("words_below").isNull(), zero).otherwise(F.lit(1).cast("long")).alias(c) for c in ("n_children", "n_leaves")],
        F.coalesce((F.col("n") - 1) * F.col("words_below"), zero).alias("saved_tokens"),
        F.when(F.col("words_below").isNull(), F.col("ends_sha256")).alias("ends_sha256"),
    ).withColumn("depth", (F.size("chain") - 1).cast("long"))
    entries.write.partitionBy("depth").parquet(f"{folder}/entries")
    columns = ["chain", *_NODE[1:]]
    entered = spark.read.parquet(f"{folder}/entries").withColumn("depth", F.col("depth").cast("long"))
    deepest = entered.agg(F.max("depth")).first()[0]

    at = F.element_at("chain", -1)
    for depth in range(deepest, -1, -1):
        here = entered.filter(F.col("depth") == depth).select(*columns)
        if depth < deepest:
            survivors = spark.read.parquet(f"{folder}/level-{depth + 1}")
            here = here.unionByName(survivors.select(
                F.slice("chain", 1, depth + 1).alias("chain"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"),
                "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends_sha256"),
            ))
        grouped = here.groupBy(at["h1"].alias("h1"), at["h2"].alias("h2")).agg(
            F.first("chain").alias("chain"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in _NODE[2:6]],
            F.max("ends_sha256").alias("ends_sha256"),
        )
        merged = grouped.select(
            F.lit(depth).cast("long").alias("depth"), "chain", "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * at["words"]).alias("saved_tokens"), "ends_sha256",
        )
        merged.write.parquet(f"{folder}/level-{depth}")

    nodes = spark.read.parquet(*[f"{folder}/level-{d}" for d in range(deepest + 1)])
    name_of = lambda place: [F.element_at("chain", place)[n].alias(n) for n in _NAME]
    names = nodes.select((F.col("depth") + 1).alias("depth"), *[c.alias(f"p_{n}") for c, n in zip(name_of(-1), _NAME, strict=True)], F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.filter("depth > 0").select(*_NODE, *[c.alias(f"p_{n}") for c, n in zip(name_of(-2), _NAME, strict=True)])
    # the first node of a tail hangs below its class's deepest shared node
    deep = entered.select("conv_id", (F.col("depth") + 1).alias("depth"), *[c.alias(f"p_{n}") for c, n in zip(name_of(-1), _NAME, strict=True)])
    heads = tails.filter("parent_conv_id is null").drop("parent_conv_id").join(deep, ["conv_id", "depth"])
    hung = inner.unionByName(heads).join(names, ["depth", "p_h1", "p_h2"], "left")
    top = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    rows = [x.select("parent_conv_id", *_NODE) for x in (hung, tails.filter("parent_conv_id is not null"), top)]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))).select(*_ORDER)


_ORDER = ["conv_id", "depth", "parent_conv_id", *_NODE[2:]]


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (``conv_id, turn, role, text``); see ``rebuilt`` and ``prefix_trie``.
    A null role or text is an empty one, a null conv_id takes no part; repeated rows are turns of their own."""
    turns, lengths = rebuilt(conversations)
    return prefix_trie(cut_lineage(turns), lengths)
