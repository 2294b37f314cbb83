"""The pipeline operators against plain Python on small tables, with nulls, empty, long and repeated rows."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import (
    decontamination,
    fuzzy_lines,
    mixing,
    near_duplicates,
    neighbours,
    quotations,
    secret_forest,
    sharding,
    toxicity,
    url_models,
)

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone cloud light paper green table music horse winter garden silver mountain orange letter".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, prose(rng, rng.randint(20, 80)), "en", f"src{i % 3}", 1) for i in range(60)]
    base = prose(rng, 120).split()
    for i in range(60, 110):  # near copies at various distances
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = "changed"
        out.append((i, " ".join(copy), "en", "src0", 1))
    out += [(110 + i, out[0][1], None, None, None) for i in range(5)]  # exact copies
    out += [(120, None, "en", "src1", 0), (121, "", "en", "src1", 0), (122, " \t\n", "en", None, None), (123, "one two", "en", "s", 1)]
    out += [(124, "ONE two", "en", "s", 1), (125, prose(rng, 30000), "en", "s", 1), (None, "no id here at all", "en", "s", 1), out[3], out[3]]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).withColumns({"shard": F.lit("x"), "mix_epoch": F.lit(9), "toxicity": F.lit("t"), "component_id": F.lit(1)}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, n):
    w = tokens(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(ids, edges):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def duplicates_by_hand(rows):
    sets = {r[0]: shingles(r[1], 3) for r in rows if r[0] is not None}
    ids = sorted(sets)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    return sets, components(ids, edges)


def test_near_duplicates(docs, rows, empty):
    sets, part = duplicates_by_hand(rows)
    got = near_duplicates.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), part[r["doc_id"]], part[r["doc_id"]] == r["doc_id"])
    assert near_duplicates.near_duplicates(empty).collect() == []


def test_odd_sketch_estimate():
    p = near_duplicates.NearDuplicateParams()
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 62, 900, dtype=np.uint64)
    a = np.unique(np.concatenate([common, rng.integers(0, 1 << 62, 50, dtype=np.uint64)]))
    b = np.unique(np.concatenate([common, rng.integers(0, 1 << 62, 50, dtype=np.uint64)]))
    x = near_duplicates.odd_sketches(near_duplicates.minima([a, b], p), p)
    z = int(np.bitwise_count(x[0] ^ x[1]).sum())
    estimate = 1 + p.sketch_bits / (4 * p.bands * p.rows) * math.log(1 - 2 * z / p.sketch_bits)
    assert abs(estimate - 0.9) < 0.12 and z <= near_duplicates.most_different_bits(p)


def test_minima_of_long_sets_do_not_depend_on_chunks(monkeypatch):
    p = near_duplicates.NearDuplicateParams()
    sets = [np.unique(np.random.default_rng(i).integers(0, 1 << 62, n, dtype=np.uint64)) for i, n in enumerate((3, 5000, 40, 1))]
    whole = near_duplicates.minima(sets, p)
    monkeypatch.setattr(near_duplicates, "CHUNK", 64)
    assert (near_duplicates.minima(sets, p) == whole).all()


def test_decontamination(spark, docs, rows, empty):
    rng = random.Random(8)
    whole = rows[5][1]
    part = " ".join(whole.split()[2:18])
    inside = " ".join(rows[-4][1].split()[20000:20030])
    items = [(1, part.upper()), (2, inside), (3, prose(rng, 25)), (4, None), (5, ""), (None, part), (6, "one two"), (7, part), (7, part)]
    items.append((8, " ".join(whole.split()[2:14]) + " " + prose(rng, 1)))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    want = sorted({
        (r[0], i, len(shingles(r[1], 5) & shingles(t, 5)), len(shingles(t, 5)))
        for r in rows for i, t in items
        if r[0] is not None and i is not None and shingles(t, 5) and 100 * len(shingles(r[1], 5) & shingles(t, 5)) >= 80 * len(shingles(t, 5))
    })
    for params in (decontamination.ContaminationParams(), decontamination.ContaminationParams(item_block=2)):
        got = decontamination.contaminated(docs, bench, params)
        assert sorted({tuple(r) for r in got.collect()}) == want
    assert {1, 2, 6, 7} <= {w[1] for w in want}
    bad = {w[0] for w in want}
    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in clean.collect()) == sorted(r[0] or -1 for r in rows if r[0] not in bad)
    assert decontamination.contaminated(empty, bench).collect() == []
    assert decontamination.contaminated(docs, bench.limit(0)).collect() == []


def test_mixing(docs, rows, empty):
    params = mixing.MixingParams(group=7, block=200)
    got = mixing.mix(docs, params).collect()
    share = defaultdict(int)
    for r in rows:
        share[r[3]] += max(1, len(tokens(r[1])))
    exponent, weights, passes = mixing.mixture({str(s): n for s, n in share.items()}, params)
    assert max(passes.values()) <= 2 + 1e-9 and min(passes.values()) >= 1 - 1e-9 and 0 <= exponent <= 1
    assert len([r for r in got if r["mix_epoch"] == 0]) == len(rows)  # every row at least once
    given = defaultdict(int)
    for r in got:
        given[r["source"]] += r["mix_tokens"]
    for s, n in share.items():
        longest = max(max(1, len(tokens(r[1]))) for r in rows if r[3] == s)
        assert passes[str(s)] * n - 1e-6 <= given[s] <= passes[str(s)] * n + longest
    assert mixing.mix(empty).collect() == []


def test_mixture_targets():
    tokens_of = {"a": 1000, "b": 100, "c": 10}
    _, w, p = mixing.mixture(tokens_of, mixing.MixingParams(most_repeats=3.0))
    assert math.isclose(max(p.values()), 3.0, rel_tol=1e-9) and math.isclose(min(p.values()), 1.0)
    _, w, _ = mixing.mixture(tokens_of, mixing.MixingParams(entropy=0.8))
    assert math.isclose(-sum(x * math.log(x) for x in w.values()), 0.8, rel_tol=1e-9)
    exponent, _, p = mixing.mixture(tokens_of, mixing.MixingParams(budget=500, most_repeats=1.0))
    assert math.isclose(sum(p[s] * n for s, n in tokens_of.items()), 500) and max(p.values()) <= 1 + 1e-9


def ring_by_hand(keys, params):
    """Every key walks on its own, in the order that the operator's counts stand for."""
    nodes = sharding.virtual_nodes(params)
    arc_at = dict(sharding.arc_of_places(nodes))
    room = sharding.capacities(len(keys), params)
    by_arc = defaultdict(list)
    for h in sorted(keys, key=lambda h: (int(h[8:14], 16) % params.buckets, h)):
        by_arc[arc_at[int(h[:4], 16)]].append(h)
    placed, waiting = defaultdict(list), []
    for arc in sorted(by_arc):
        for h in by_arc[arc]:
            shard = nodes[arc][1]
            if len(placed[shard]) < room[shard]:
                placed[shard].append(h)
            else:
                waiting.append((arc, h))
    for arc, h in waiting:
        step = 1
        while len(placed[nodes[(arc + step) % len(nodes)][1]]) >= room[nodes[(arc + step) % len(nodes)][1]]:
            step += 1
        placed[nodes[(arc + step) % len(nodes)][1]].append(h)
    return placed


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_sharding(docs, rows, empty, slack):
    import hashlib

    params = sharding.RingParams(shards=7, virtual_nodes=4, buckets=2, slack=slack)
    got = sharding.shard(docs, params).withColumn("h", F.md5(F.concat_ws("/", F.lit("17"), F.lit("key"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))).collect()
    keys = [hashlib.md5(f"17/key/{'' if r[0] is None else r[0]}".encode()).hexdigest() for r in rows]
    want = ring_by_hand(keys, params)
    mine = defaultdict(list)
    for r in sorted(got, key=lambda r: r["slot"]):
        mine[r["shard"]].append(r["h"])
    assert {s: v for s, v in mine.items()} == {s: v for s, v in want.items() if v}
    for s in mine:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(len(mine[s])))
    counts = [len(mine[s]) for s in range(7)]
    assert sum(counts) == len(rows) and max(counts) <= max(sharding.capacities(len(rows), params))
    if not slack:
        assert max(counts) - min(counts) <= 1
    assert sharding.shard(empty).collect() == []


def toxic_tables(spark):
    rng = random.Random(3)
    bad = ["nastyword", "vileness"]
    texts, labels = [], []
    for i in range(400):
        t = prose(rng, rng.randint(10, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            t.insert(rng.randrange(len(t)), rng.choice(bad))
        texts.append((i, " ".join(t)))
        labels.append((i, 1, int(toxic)))
    extra = [(1000, "n4styw0rd river stone"), (1001, "v i l e n e s s of it"), (1002, "nnnaaastyworrrd table"), (1003, "n.a.s.t.y.w.o.r.d music"), (1004, "river stone"), (1005, None), (1006, ""), (None, "nastyword")]
    extra.append((1007, "river " * 40000 + "nastyword"))
    docs = spark.createDataFrame(texts + extra, "doc_id long, text string").withColumn("rejected", F.lit("clash"))
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, empty):
    docs, labels = toxic_tables(spark)
    got = {r["doc_id"]: r for r in toxicity.judge(docs, labels).collect()}
    assert len(got) == 409
    for i in range(400):
        assert got[i]["rejected"] == (i % 5 == 0), i
    for i in (1000, 1001, 1002, 1003, 1007, None):
        assert got[i]["rejected"], i
    assert not any(got[i]["rejected"] for i in (1004, 1005, 1006))
    assert all(0 <= r["toxicity"] <= 1 for r in got.values())
    none = toxicity.judge(docs, labels.limit(0)).select("toxicity").distinct().collect()
    assert [r[0] for r in none] == [0.5]
    assert toxicity.judge(empty, labels).collect() == []
    model = toxicity.fit(docs, labels)
    text = {r["doc_id"]: r["restored"] for r in toxicity.restored(docs, model).collect()}
    assert text[1000] == "nastyword river stone" and text[1001].startswith("vileness") and text[1005] is None
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held.items())


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    x = (centres[rng.integers(0, 12, 3000)] + 0.6 * rng.standard_normal((3000, 16))).astype(np.float32)
    x[500:900] = x[500]  # copies: ties
    data = [(i, [float(v) for v in x[i]]) for i in range(3000)]
    odd = [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [None] * 16), (3080, [1.0, 2.0]), (None, [1.0] * 16)]
    vectors = spark.createDataFrame(data + odd + data[:3], "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    queries = vectors.filter("vec_id % 20 = 0")
    params = neighbours.NeighbourParams(partitions=8, sample=1500, probe_sample=150, vector_block=128, query_block=16)
    got = defaultdict(list)
    for r in neighbours.search(vectors, queries, params).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    x = x.astype(np.float64)
    hits = 0
    assert sorted(got) == list(range(0, 3000, 20))
    for q, found in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(3000), -s))[:20]
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(math.isclose(v, s[i], rel_tol=1e-12) for _, i, v in found)
        assert [(-v, i) for _, i, v in found] == sorted((-v, i) for _, i, v in found)
        hits += len(set(want.tolist()) & {i for _, i, _ in found})
    assert hits / (20 * len(got)) >= 0.9
    assert neighbours.search(vectors.limit(0), queries).collect() == []
    few = neighbours.search(vectors.filter("vec_id < 5"), queries.filter("vec_id = 0")).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]


def test_neighbours_of_repeated_rows(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 8))
    data = [(i, [float(v) for v in x[i]]) for i in range(300)]
    best = int(np.argmax(x @ x[0]))
    others = [(500, [float(v) for v in x[0] * (2 + j / 100)]) for j in range(40)]  # one id with many near vectors
    vectors = spark.createDataFrame(data * 3 + [data[best]] * 30 + others, "vec_id long, embedding array<double>")
    params = neighbours.NeighbourParams(partitions=1, sample=200, probe_sample=20)
    got = defaultdict(list)
    for r in neighbours.search(vectors, vectors.filter("vec_id % 20 = 0 and vec_id < 300"), params).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        scores = {i: float(x[i] @ x[q]) for i in range(300) if i != q} | {500: max(float(np.dot(v, x[q])) for _, v in others)}
        assert found == list(enumerate(sorted(scores, key=lambda i: (-scores[i], i))[:20], 1))


def test_balanced_parts():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1200, 8))
    label = neighbours.balanced_parts(neighbours.nearest(x, x, 8, skip_own=True), 6, rng)
    sizes = np.bincount(label, minlength=6)
    assert sizes.sum() == 1200 and sizes.max() <= math.ceil(200 * 1.05)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_lines(spark, empty):
    rng = random.Random(6)
    params = fuzzy_lines.FuzzyLineParams()
    base = prose(rng, 60)
    texts = []
    for i in range(40):
        lines = [prose(rng, rng.randint(3, 12)), "Page 12 of 30!" if i % 2 else "page 34 of 56"]
        words = base.split()
        words[rng.randrange(60)] = words[0] if i % 3 else words[-1]
        lines.append(" ".join(words))
        rng.shuffle(lines)
        texts.append((i, "\n".join([*lines, "", "--"])))
    texts += [(50, None), (51, ""), (52, base + "\n" + base), (None, base), (53, "word " * 30000), texts[0]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    got = fuzzy_lines.dedup_lines(docs, params).collect()

    def norm(line):
        return re.sub(r"[0-9]", "0", re.sub(r"[\W_]+", " ", line.lower())).strip()

    first = {}
    for d, t in sorted(((d, t) for d, t in texts if d is not None and t is not None), key=lambda r: r[0]):
        for n, line in enumerate(t.split("\n")):
            if norm(line):
                first.setdefault(norm(line), (d, n))
    hashes = {r["first"]: r["simhash"] for r in fuzzy_lines.simhashes(fuzzy_lines.different_lines(fuzzy_lines.lines_of(docs))).select(F.struct("first_doc", "first_line").alias("first"), "simhash").collect()}
    names = list(first)
    edges = []
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            differ = bin((hashes[first[a]] ^ hashes[first[b]]) & ((1 << 64) - 1)).count("1")
            longer = max(len(a), len(b))
            if differ <= params.bits and min(len(a), len(b)) >= params.similarity * longer and distance(a, b) <= math.floor((1 - params.similarity) * longer + 1e-9):
                edges.append((first[a], first[b]))
    assert edges
    group = components(list(first.values()), edges)
    for r in got:
        text = dict(texts).get(r["doc_id"])
        if r["doc_id"] is None or text is None:
            assert r["text"] == (base if r["doc_id"] is None else None) and r["n_removed"] == 0
            continue
        want = [line for n, line in enumerate(text.split("\n")) if not norm(line) or group[first[norm(line)]] == (r["doc_id"], n)]
        assert r["text"] == "\n".join(want) and r["n_lines"] == len(text.split("\n"))
        assert r["n_removed"] == r["n_lines"] - len(want)
    assert fuzzy_lines.dedup_lines(empty).collect() == []


def test_fuzzy_lines_of_every_length(spark):
    """Against brute-force edit similarity alone: lines at every length with one letter changed or near the limit."""
    rng = random.Random(12)
    bands = [(12, 19), (20, 29), (30, 59), (60, 119), (120, 199), (200, 300)]
    lines = []
    for low, high in bands:
        for _ in range(10):
            line = prose(rng, 60)[: rng.randint(low, high)].strip()
            line = line.replace(line[0], rng.choice("bcdfgkmp"), 1) + rng.choice("xyz")
            lines.append((low, line))
            for edits in (1, max(1, len(line) // 10)):
                copy = list(line)
                for at in rng.sample(range(len(copy)), edits):
                    copy[at] = rng.choice("bcdfghjk")
                lines.append((low, "".join(copy)))
    lines = [(low, " ".join(line.split())) for low, line in lines]
    docs = spark.createDataFrame([(i, line) for i, (_, line) in enumerate(lines)], "doc_id long, text string")
    rows = fuzzy_lines.lines_of(docs)
    kept = {r["doc_id"]: r["keep_doc"] for r in rows.join(fuzzy_lines.line_groups(rows), "id").collect()}
    assert len(kept) == len(lines)
    true, found, edges = defaultdict(int), defaultdict(int), []
    for i, (low, a) in enumerate(lines):
        for j in range(i + 1, len(lines)):
            b = lines[j][1]
            longer = max(len(a), len(b))
            if min(len(a), len(b)) >= 0.9 * longer and distance(a, b) <= math.floor(0.1 * longer + 1e-9):
                edges.append((i, j))
                true[low] += 1
                found[low] += kept[i] == kept[j]
    group = components(range(len(lines)), edges)
    assert all(group[kept[i]] == group[i] for i in kept)  # nothing joined that brute force does not join
    assert len(true) == len(bands) and all(found[low] >= 0.9 * true[low] for low in true), (true, found)


def test_fuzzy_lines_in_blocks(spark, monkeypatch):
    """The keys of many lines are worked on in blocks, which changes nothing; shuffle files go with their step."""
    rng = random.Random(5)
    lines = [prose(rng, rng.randint(4, 40)) for _ in range(150)]
    lines += [f"{line} and" for line in lines[::3]] + [f"an {line}" for line in lines[::5]] + [line.replace("e", "o", 1) for line in lines]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    rows = fuzzy_lines.lines_of(docs)

    def groups(limit):
        monkeypatch.setattr(fuzzy_lines, "BLOCK_ROWS", limit)
        return fuzzy_lines.line_groups(rows)

    def shuffled():
        held = files.getAllFiles().mkString("\n").split("\n")
        return {f for f in held if f.endswith(".data") and "/shuffle_" in f}

    before = shuffled()
    whole, blocks = groups(10**9), groups(1)
    assert len(shuffled() - before) <= 4
    assert len(fuzzy_lines._blocks(10)) == 16 and [t for block in fuzzy_lines._blocks(10) for t in block] == list(range(32))
    whole = {r["id"]: (r["keep_doc"], r["keep_line"]) for r in whole.collect()}
    assert whole == {r["id"]: (r["keep_doc"], r["keep_line"]) for r in blocks.collect()}
    assert len(set(whole.values())) < len(whole)


def test_quotations(spark):
    rows = [
        (1, 0, "user", "First question.\nSecond line."),
        (1, 1, "assistant", "> First question.\n> Second line.\nAn answer."),
        (1, 2, "user", "> > First question.\n>> Second line.\n> An answer.\nThanks"),
        (1, 3, "assistant", ">FIRST   question.\n> second line.\nOther answer"),
        (1, 4, "user", "> never said\nHello"),
        (1, 5, None, None),
        (1, 5, "user", ""),
        (2, 0, "user", "> An answer.\nelsewhere"),
        (2, 1, "user", "> elsewhere\n> > nested unknown\n>\nx"),
        (None, 0, "user", "lost"), (3, None, "user", "lost"),
        (4, 0, "user", "long " * 20000 + "\n" + "> q\n" * 5000),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
    got = {(r["conv_id"], r["turn"]): r for r in quotations.reply_conversations(messages).collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 0), (2, 1), (4, 0)]
    assert [got[1, t]["reply_to"] for t in range(6)] == [None, 0, 1, 0, None, None]
    assert [got[1, t]["depth"] for t in range(6)] == [0, 1, 2, 1, 0, 0]
    assert [got[1, t]["thread"] for t in range(6)] == [0, 0, 0, 0, 4, 5]
    assert [got[1, t]["reply_order"] for t in range(6)] == [0, 1, 3, 2, 4, 5]
    assert got[1, 2]["text"] == "Thanks" and got[1, 2]["deepest"] == 2 and got[1, 2]["n_linked"] == 2
    assert got[2, 0]["n_linked"] == 1 and got[2, 0]["reply_to"] is None
    assert got[2, 1]["reply_to"] == 0 and got[2, 1]["n_quotes"] == 3
    assert got[1, 1]["formatted"] == "<|assistant|>\nAn answer.\n"
    assert got[4, 0]["n_quotes"] == 1
    assert quotations.reply_conversations(messages.limit(0)).collect() == []


def test_long_reply_chain(spark):
    rows = [(7, i, "user", (f"> text {i - 1}\n" if i else "") + f"text {i}") for i in range(300)]
    got = quotations.reply_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all(r["depth"] == r["turn"] == r["reply_order"] and r["thread"] == 0 for r in got)


def test_url_rules_and_model(spark):
    rng = random.Random(9)
    good, bad = ["news", "wiki", "learn", "books"], ["casino", "pills", "xxx", "spin"]
    rows = [(i, f"https://{rng.choice(good)}{rng.randint(1, 99)}.ok.com/{rng.choice(good)}/{rng.randint(1, 999)}") for i in range(300)]
    rows += [(300 + i, f"http://{rng.choice(bad)}{rng.randint(1, 99)}.bad.net/es/{rng.choice(bad)}/{rng.randint(1, 999)}") for i in range(300)]
    probes = [(700, "https://news5.site.org/books/77"), (701, "http://casino9.site.org/pills/7"), (702, None), (703, ""), (704, "no scheme.com/"),
              (705, "HTTP://WWW.Example.COM/en/a?x#y"), (706, "http://a.example.com/en/a"), (707, "http://example.com/fr/"), (708, "http://notexample.com/en/"),
              (709, "http://com"), (710, "ftp://x.net/esx"), (711, "http://" + "a" * 30000 + ".org/"), (None, "http://b.net/fr/1"), (700, "https://news5.site.org/books/77")]
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    pages = spark.createDataFrame(rows + probes, "page_id long, url string").withColumn("verdict", F.lit("clash"))
    got = url_models.judge_urls(pages, rules).collect()
    assert len(got) == len(rows) + len(probes)
    by = {r["page_id"]: r for r in got}
    assert (by[700]["verdict"], by[701]["verdict"]) == ("allow", "block")
    assert by[702]["host"] == by[702]["path"] == by[703]["host"] == by[704]["host"] == "" and by[702]["rule"] is None
    assert (by[705]["host"], by[705]["path"], by[705]["rule"], by[705]["verdict"]) == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert (by[706]["rule"], by[706]["verdict"]) == ("example.com/en/", "block")
    assert by[707]["rule"] == "com/" and by[708]["rule"] == "com/" and by[709]["rule"] is None and by[710]["rule"] is None
    assert (by[None]["rule"], by[None]["verdict"]) == ("net/fr/", "block")
    assert {r["verdict"] for r in got} == {"allow", "block"}
    assert url_models.judge_urls(pages.limit(0), rules).collect() == []
    alone = url_models.judge_urls(pages.filter("page_id >= 700"), []).collect()
    assert {r["verdict"] for r in alone} == {"allow"}


def test_url_scores_by_hand(spark):
    urls = ["ab", "abc", "xyx", "b", ""]
    accepted = [True, True, False, False, None]
    params = url_models.UrlModelParams(order=2, folds=1 << 30)  # all but one in 2^30 train
    frame = spark.createDataFrame([(i, i + 1, u, a) for i, (u, a) in enumerate(zip(urls, accepted, strict=True))], "a long, b long, url string, accepted boolean")
    got = {r["a"]: r["score"] for r in url_models.url_scores(frame, params).collect()}

    def chain(kind, gram):
        p = 1 / 256
        for w in range(1, len(gram) + 1):
            part = gram[-w:]
            n = all_n = 0
            for u, a in zip(urls, accepted, strict=True):
                if a is kind:
                    padded = "\x02\x02" + u + "\x03"
                    for i in range(2, len(padded)):
                        seen = padded[i - w + 1 : i + 1]
                        n += seen == part
                        all_n += seen[:-1] == part[:-1]
            p = (n + params.strength * p) / (all_n + params.strength)
        return math.log(p)

    for i, u in enumerate(urls):
        padded = "\x02\x02" + u + "\x03"
        grams = [padded[j - 2 : j + 1] for j in range(2, len(padded))]
        want = sum(chain(True, g) - chain(False, g) for g in grams) / len(grams)
        assert math.isclose(got[i], want, rel_tol=1e-9, abs_tol=1e-12)


def test_secret_scan(spark, empty):
    rng = random.Random(12)

    def hexes(n):
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    rows, labels = [], []
    for i in range(300):
        key = i % 2 == 0
        value = hexes(18) if key else "-".join(rng.choice(WORDS) for _ in range(3)) + f"-{rng.randint(1, 99)}"
        line = f'{prose(rng, 5)} {"password=" if key else "see docs/"}{value} {prose(rng, 5)}'
        rows.append((i, line))
        if i % 3:
            labels.append((i, 5 if key else 6, value if key else "docs/" + value, key))
    rows += [(900, None), (901, ""), (None, f"token = {hexes(20)}"), (902, f'token = "{hexes(40)}" x'), (903, hexes(60000)), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    judged = spark.createDataFrame([*labels, (1, 5, "x", None), labels[0]], "doc_id long, at int, candidate string, secret boolean")
    found = secret_forest.findings(docs)
    want = [(d, len(t.split()[:i])) for d, t in rows if t for i, w in enumerate(t.split()) if any(re.search("[0-9]", r) and re.search("[A-Za-z]", r) for r in re.findall(r"[A-Za-z0-9+/_\-]{12,}", w))]
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["at"]) for r in found.collect()) == sorted((d if d is not None else -1, a) for d, a in want)
    got = secret_forest.scan(docs, judged).collect()
    assert len(got) == len(want)
    right = [r["is_secret"] == (r["doc_id"] % 2 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 300 and r["doc_id"] % 3 == 0]
    assert sum(right) / len(right) > 0.95
    kept = secret_forest.scan(docs, judged.limit(0)).collect()
    assert len(kept) == len(want) and all(r["is_secret"] and r["score"] == 1.0 for r in kept)
    assert secret_forest.scan(empty, judged).collect() == []
