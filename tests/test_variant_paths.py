"""Paths compiled to VARIANT: known answers, agreement with trees on random documents, text forms, plans without Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators.shred import shred
from gleaner.operators.steps import Path, path, resolve, value_json
from gleaner.operators.variant_paths import (
    float_text, json_all_of, json_any_of, json_fields, json_schema, json_values, parsed, resolve_json, spaced,
)
from test_steps import CASES, FARM, answer


@pytest.fixture(scope="module")
def farm(spark):
    return parsed(spark.createDataFrame([(json.dumps(FARM),)], "body string"), "body").cache()


@pytest.mark.parametrize("at", range(len(CASES)))
def test_path(farm, at):
    expression, expected = CASES[at]
    assert answer(resolve_json(farm, expression, "r")) == expected


def random_documents(seed, count):
    rng = random.Random(seed)
    scalars = [1, "a", "bcd", None, True, 2.5, 1e20, 1.0, -0.00001234, 12345678.25, 123456789012345678901234, 'q"u, o:\\te', "é ü:x", "", 1e7]

    def value(depth):
        kind = rng.random()
        if depth < 4 and kind < 0.4:
            return {k: value(depth + 1) for k in rng.sample("abcd", rng.randint(0, 4))}
        if depth < 4 and kind < 0.65:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        if kind < 0.75:
            return json.dumps(value(depth + 1) if depth < 4 else {"a": 1})
        return rng.choice(scalars)

    return [json.dumps(value(0), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) for _ in range(count)]


def test_agrees_with_trees(spark):
    rows = [*enumerate(random_documents(7, 400)), (900, "bad"), (901, None), (902, "  "), (903, '"{\\"a\\": {\\"b\\": 1}}"'), (904, '"{torn"')]
    df = spark.createDataFrame(rows, "id long, body string").repartition(2).cache()
    trees, payloads = shred(df, "body", "json").cache(), parsed(df, "body").cache()
    paths = [
        Path(), path("a", "b"), path("a").index(0).key("b"), path("a").slice(0, 2), path("b").where_child("a", "1").key("c"),
        Path().recurse("c"), path("a").recurse("*[bc]*"), path("a").recurse("b").key("a"), path("c").where_value_not("a"),
        Path().recurse("a").up(1).key("b"), path("d").keys(), path("a").where_child("*", "a").index(-1), Path().values(),
        Path().slice(0, 2).recurse("*"), Path().index(1), Path().pick(2, 0).up(1),
    ]
    for expression in paths:
        read = lambda found: dict(found.select("id", value_json("r")).collect())
        assert read(resolve_json(payloads, expression, "r")) == read(resolve(trees, expression, "r"))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "{}")], "id long, body string")
    plan = lambda d: d._jdf.queryExecution().toString()
    schema = {"x": path("a").slice(0, 2).key("b"), "y": path("c").where_child("d", "/e/"), "z": Path().recurse("f").up(1)}
    assert "Arrow" not in plan(json_schema(df, "body", schema, "id")) + plan(json_values(df, "body", schema["z"], "id"))
    assert "Arrow" not in plan(json_fields(df, "body", schema))


def test_spaced_text_is_what_a_json_writer_gives(spark):
    rows = [(i, json.dumps(json.loads(d), ensure_ascii=False)) for i, d in enumerate(random_documents(3, 300))]
    long = {"t": 'a,:"\\' * 20_000, "n": [1.5] * 2000}  # no pattern may recurse over a long text
    rows.append((999, json.dumps(long)))
    df = spark.createDataFrame(rows, "id long, want string").filter("left(want, 1) in ('{', '[')")
    tight = F.get_json_object("want", "$")
    df = df.withColumn("tight", tight).withColumn("got", F.expr(spaced("tight")))
    assert df.filter("got != want or got is null").collect() == []


def test_float_text(spark):
    rng = random.Random(11)
    numbers = [0.0, -0.0, 1.0, 0.1, 1e-4, 9.99e-5, 1e15, 1e16, 123456789.125, 1.7976931348623157e308]
    numbers += [float(f"{rng.uniform(-1, 1) * 10 ** rng.randint(-20, 20):.12g}") for _ in range(200)]
    df = spark.createDataFrame([(x, repr(x)) for x in numbers], "x double, want string").withColumn("text", F.col("x").cast("string"))
    # before Java 19 some numbers come with more digits than needed
    shortest = F.length(F.regexp_replace("text", "E.*|[^0-9]", "")) <= 17
    df = df.filter(shortest & ~F.col("text").rlike("9999|0000[1-9]"))
    assert df.filter(F.expr(float_text("text")) != F.col("want")).collect() == [] and df.count() > 180


def test_unions_and_fields(spark):
    df = parsed(spark.createDataFrame([('{"x": 10, "y": [20, 30]}',)], "body string"), "body")
    assert answer(json_any_of(df, path("x"), path("z"), path("y"), out="r")) == [10, 20, 30]
    assert answer(json_all_of(df, path("x"), path("z"), out="r")) is None
    assert answer(json_all_of(df, path("x"), path("y").slice(9, None), out="r")) == [10]
    rows = [(1, '{"title": "T", "price": 9.99, "more": 1}'), (2, '[{"title": "A"}, {"price": 1}, 7]'), (3, "no json"), (4, '{"x": 1}'), (5, "[]"), (6, None)]
    docs = spark.createDataFrame(rows, "id long, body string")
    schema = {"t": path("title"), "p": path("price"), "gone": path("nothing")}
    assert {r.id: json.loads(r.record) for r in json_schema(docs, "body", schema, "id").collect()} == {1: {"t": "T", "p": 9.99}, 2: {"t": ["A"], "p": [1]}}
    kept = sorted((r.id, -1 if r.item is None else r.item, r.filtered) for r in json_fields(docs, "body", schema).collect() if r.id != 6)
    assert kept == [
        (1, -1, '{"t": "T", "p": 9.99}'), (2, 0, '{"t": "A"}'), (2, 1, '{"p": 1}'), (2, 2, "{}"), (3, -1, "no json"), (4, -1, "{}"),
    ]


def test_keys_with_signs_and_bytes(spark):
    document = {"it's": 1, "a?b": {"c\\d": 2}, 'say "x"': {"e.f": 3}, "": 4, "$": 5, "[0]": 6}
    df = parsed(spark.createDataFrame([(bytearray(json.dumps(document).encode()),)], "body binary"), "body")
    for expression, want in ((path("it's"), 1), (path("a?b", "c\\d"), 2), (path('say "x"', "e.f"), 3), (path(""), 4), (path("$"), 5), (path("[0]"), 6)):
        assert answer(resolve_json(df, expression, "r")) == want
    assert answer(resolve_json(df, Path().values().index(-1), "r")) == 6


def test_last_key_of_a_list(spark):
    """A list's dicts are looked up at once; anything else in the list, and null or missing values, as over trees."""
    lists = ['[]', '[{"b": 1}, {"c": 2}, {"b": null}, {"b": "x"}]', '[{"b": {"z": 1, "a": [1, "t"]}}, {"b": [1, 2]}, {"b": []}]',
             '[{"b": 1}, 5, null]', '[[{"b": 1}], {"b": 2}]', '["{\\"b\\": 7}", {"b": "{\\"q\\": 1}"}]', '{"b": [1]}', 'null', '[null, {"b": 3}]', '[{"B": 1}]']
    df = spark.createDataFrame([(i, f'{{"a": {x}, "p": {{"a": {x}}}}}') for i, x in enumerate(lists)], "id long, body string")
    trees = shred(df, "body", "json")
    for expression in (path("a", "b"), path("p", "a", "b"), path("a").key("b").index(0)):
        found = {r.id: r.r for r in resolve_json(parsed(df, "body"), expression, "r").collect()}
        assert found == {r.id: r.r for r in resolve(trees, expression, "r").collect()}
    plan = resolve_json(parsed(df, "body"), path("a", "b"), "r")._jdf.queryExecution().analyzed().toString()
    assert "array<struct<b:variant>>" in plan.lower() or "struct<b:variant>" in plan.lower() or "StructField(b,VariantType" in plan


def test_spaced_texts_without_a_pattern(spark):
    docs = [{"a": [1, 2.5, -3], "b:c,d": {"e": "x:y, z\\\"q", "f": []}, "g": None}, {"E": 1}, [[], {}, "E,E:"]]
    df = spark.createDataFrame([(json.dumps(d, separators=(",", ":")), json.dumps(d)) for d in docs], "t string, want string")
    assert df.filter(F.expr(spaced("t")) != F.col("want")).collect() == []
    assert "'([,:])'" not in spaced("t")
