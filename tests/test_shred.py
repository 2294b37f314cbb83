"""Nodes: positions, text cuts and formats, checked against a plain walk over random trees."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators.parsers import parse_payload
from gleaner.operators.shape import flatten_records
from gleaner.operators.shred import _Nodes, _tree_array, detect_format, shred
from gleaner.plans import QUERIES


def random_tree(rng, depth=0):
    kind = rng.random()
    if depth < 4 and kind < 0.3:
        return {rng.choice(["a", "é", 'k"x', "b.c", "", "z"]) + str(i or "q"): random_tree(rng, depth + 1) for i in range(rng.randint(0, 4))}
    if depth < 4 and kind < 0.55:
        return [random_tree(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    if kind < 0.62:
        return json.dumps(random_tree(rng, depth + 1) if depth < 3 else [1, "x"])
    return rng.choice([1, 2.5, None, True, False, 'é\n"', "plain", "{bad", "\ud800x", 1e30, float("inf"), -0.0, ""])


def test_every_fact_of_every_node():
    rng = random.Random(3)
    trees = [random_tree(rng) for _ in range(800)]
    batch = _Nodes(paths=True)
    texts = [batch.add(tree) for tree in trees]
    for tree, row in zip(trees, _tree_array(["json"] * len(trees), texts, batch).to_pylist()):
        nodes, text, seen = row["nodes"], row["json"], 0

        def walk(value, parent, key, pos, depth, embedded):
            nonlocal seen
            me, seen = seen, seen + 1
            node = nodes[me]
            assert (node["id"], node["parent"], node["pos"], node["depth"], node["embedded"]) == (me, parent, pos, depth, embedded)
            assert text[node["at"] : node["at"] + node["size"]] == json.dumps(value, ensure_ascii=False).encode("utf-8", "replace")
            kids = []
            if isinstance(value, dict):
                parts = [(k, p, v) for p, (k, v) in enumerate(value.items())]
            elif isinstance(value, list):
                parts = [(None, p, v) for p, v in enumerate(value)]
            else:
                parts = []
                if isinstance(value, str) and value.startswith(("{", "[")):
                    try:
                        kids.append(seen)
                        walk(json.loads(value), me, None, 0, depth + 1, True)
                    except ValueError:
                        kids.clear()
            for k, p, v in parts:
                kids.append(seen)
                walk(v, me, k, p, depth + 1, embedded)
            assert node["kids"] == kids and node["last"] == seen - 1

        walk(tree, None, None, 0, 0, False)
        assert seen == len(nodes)


FORMATS = [
    (b'{"key": "value"}', "json", {"key": "value"}),
    (b"[1, 2, 3]", "json", [1, 2, 3]),
    (b'{"a": 1}\n\n{"a": 2}', "ndjson", [{"a": 1}, {"a": 2}]),
    (b'{"a": 1}\n{broken', "text", ['{"a": 1}', "{broken"]),
    (b"<html><body><p>Hello</p></body></html>", "html", {"body": {"p": "Hello"}}),
    (b'<?xml version="1.0"?><root><item>test</item></root>', "xml", {"item": "test"}),
    (b'<?xml version="1.0"?><root><item>test</root>', "html", None),
    (b"name,age\nAlice,30\nBob,25", "csv", [{"name": "Alice", "age": "30"}, {"name": "Bob", "age": "25"}]),
    (b"only one column\nx", "text", ["only one column", "x"]),
    (b"# Title\nSome text\n## Section\nMore text", "markdown", {"Title": {"text": "Some text", "Section": {"text": "More text"}}}),
    (b"Title\n=====\nbody", "markdown", {"Title": {"text": "body"}}),
    (b"Just some plain text\nwith lines", "text", ["Just some plain text", "with lines"]),
    (b"", None, None),
    (b"   ", None, None),
]


@pytest.mark.parametrize("body,format,tree", FORMATS)
def test_format(body, format, tree):
    found, parsed = parse_payload(body)
    assert found == format
    if tree is not None:
        assert parsed == tree


def test_markup_mapping():
    parse = lambda text: parse_payload(text.encode())[1]
    assert parse('<div id="x">one<b>two</b>three<b>four</b><br></div>') == {
        "id": "x", "b": ["two", "four"], "tail_text": ["three"], "br": "", "text": "one",
    }
    assert parse("<ul><li>a<li>b</ul>") == {"li": ["a", "b"]}
    assert parse("<p>a<!-- c -->dropped<i>b</i></p>") == {"i": "b", "text": "a"}


def test_markdown_details():
    parse = lambda text: parse_payload(text.encode(), "markdown")[1]
    assert parse("# A\n## S\n## S\n# B\n| h | k |\n|---|---|\n| 1 |\n\nend") == {
        "A": {"S": {}, "S (2)": {}}, "B": {"tables": [{"h": "1", "k": ""}], "text": "end"},
    }
    assert parse("plain only") is None


def test_spark_job(spark):
    rows = [(i, body) for i, (body, _, _) in enumerate(FORMATS)]
    df = spark.createDataFrame(rows, "id long, body binary")
    want = {i: format for i, (_, format, _) in enumerate(FORMATS)}
    assert dict(detect_format(df, "body").collect()) == want
    trees = shred(df, "body")
    assert {r.id: r.format for r in trees.select("id", "tree.format").collect()} == want
    split = shred(df, "body", split_lists=True).filter(F.col("item").isNotNull())
    assert split.count() == 3 + 2 + 2 + 2 + 2 + 2  # items of the six list documents


def test_flattening_needs_no_nodes_of_json_inside_strings(spark):
    bodies = ['{"a": {"b": "{\\"c\\": [1, {\\"d\\": 2}]}", "e": ["[1]", 2]}, "f": [{"g": "[3]"}, 4]}', '[{"x": "{\\"y\\": 1}"}, {"x": "{bad"}]', '"{\\"z\\": 1}"', "no json"]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    whole = shred(df, "body", "json", paths=True)
    plain = shred(df, "body", "json", paths=True, embedded=False)
    assert plain.filter("exists(tree.nodes, n -> n.embedded)").count() == 0 < whole.filter("exists(tree.nodes, n -> n.embedded)").count()
    for depth in (None, 1):
        cells = lambda trees: sorted((r.id, r.rec, list(r.cells.items())) for r in flatten_records(trees, "id", max_depth=depth).collect())
        assert len(cells(whole)) == 3 and cells(plain) == cells(whole)


def test_the_counts_of_shred_json_look_at_the_nodes_once(spark):
    plan = QUERIES["shred_json"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(tree" in plan and "filter(own" not in plan
