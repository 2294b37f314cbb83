"""The prefix trie against one built node by node in plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleaner.llm import prefix_trie as trie

KIND = "conv_id long, turn long, role string, text string"


def rebuilt_by_hand(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = sorted(turns.get(conv - conv % 20, []))
        out[conv] = [t[2:] for t in [*base[:h], *sorted(own)[h:]]]
    return out


def trie_by_hand(convs):
    """Rows by definition: ``(conv_id, depth) -> (parent, convs, children, leaves, saved, digest)``."""
    members = defaultdict(list)
    for conv in sorted(convs):
        for d in range(len(convs[conv]) + 1):
            members[tuple(convs[conv][:d])].append(conv)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    out = {}
    for key in sorted(members, key=len, reverse=True):
        below = [out[k] for k in children[key]]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        ends = ",".join(str(c) for c in members[key] if len(convs[c]) == len(key))
        out[key] = {
            "conv_id": members[key][0], "depth": len(key), "parent_conv_id": members[key[:-1]][0] if key else None,
            "n_convs": len(members[key]), "n_children": len(below), "n_leaves": sum(b["n_leaves"] for b in below) or 1,
            "saved_tokens": sum(b["saved_tokens"] for b in below) + (len(members[key]) - 1) * words,
            "ends_sha256": hashlib.sha256(ends.encode()).hexdigest(),
        }
    return sorted((tuple(v.items()) for v in out.values()), key=repr)


def rows_of(df):
    return sorted((tuple(r.asDict().items()) for r in df.collect()), key=repr)


def conversations(seed, count=90, length=7):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(400), count):
        for turn in range(rng.choice([0, 1, 2, length, rng.randint(1, length)])):
            rows.append((conv, turn, "user" if turn % 2 else "assistant", rng.choice(["yes", "no", "tell me  more\n", " "])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_brute_force(spark, seed):
    rows = conversations(seed)
    rows += [(401, None, "user", "first"), (401, 1, None, None), (401, 0, "user", "x"), (None, 1, "user", "x"), (402, 3, "user", "alone")]
    rows += [(420, t, "user", "same") for t in range(5)] + [(440, t, "user", "same") for t in range(5)] * 2  # rows that come twice
    rows += [(-7, 0, "user", "below zero"), (-20, 0, "user", "its base"), (-20, 1, "user", "more")]
    given = spark.createDataFrame(rows, KIND).withColumns({"depth": F.lit("clash"), "h1": F.lit(1)}).repartition(5)
    want = rebuilt_by_hand([r for r in rows if r[0] is None or r[0] >= 0])
    # a conversation below zero: c - c % 20 is a multiple of 20 towards zero
    for conv in (-7, -20):
        h = zlib.crc32(str(conv).encode()) % 4
        base = {-7: 0, -20: -20}[conv]
        own, head = (sorted((t[1], t[2], t[3]) for t in rows if t[0] == c) for c in (conv, base))
        want[conv] = [t[1:] for t in [*head[:h], *own[h:]]]
    got = trie.conversation_trie(given)
    assert rows_of(got) == trie_by_hand(want)


def test_long_and_hot(spark, monkeypatch):
    """A conversation longer than a piece, copies of it, and one that shares most of it; many that are equal."""
    monkeypatch.setattr(trie, "CHUNK", 16)
    long = [("user", f"turn {i} " + "word " * (i % 5)) for i in range(100)]
    convs = {i: list(long) for i in (3, 5, 9)} | {11: [*long[:40], ("user", "other"), *long[41:]], 12: long[:55], 13: []}
    convs |= {100 + i: [("user", "hello"), ("assistant", "hello you")] for i in range(300)} | {500: [("user", "hello")]}
    rows = [(c, d, r, t) for c, turns in convs.items() for d, (r, t) in enumerate(turns, 1)]
    turns = spark.createDataFrame(rows, "conv_id long, depth long, role string, text string").select(
        "conv_id", "depth", F.xxhash64("role", "text").alias("t1"), F.xxhash64("text", "role").alias("t2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    lengths = spark.createDataFrame([(c, len(t)) for c, t in convs.items()], "conv_id long, length int")
    assert rows_of(trie.prefix_trie(turns, lengths)) == trie_by_hand(convs)


def test_one_conversation_and_none(spark):
    assert trie.conversation_trie(spark.createDataFrame([], KIND)).count() == 0
    rows = [(8, t, "user", "a b c") for t in range(4)]
    assert rows_of(trie.conversation_trie(spark.createDataFrame(rows, KIND))) == trie_by_hand(rebuilt_by_hand(rows))
    got = trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], KIND))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got.count() == 0
