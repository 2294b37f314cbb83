"""Path steps on small documents with known answers, and pruning against whole documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators.reach import prune, reach_of
from gleaner.operators.shred import shred
from gleaner.operators.steps import (
    Path, all_of, any_of, extract_schema, fast_values, filter_fields, path, resolve, shred_for, value_json,
)

def _farm(rng):
    """A made-up farm register: dicts, lists, lists of lists, JSON inside a text, keys with dots."""
    kinds, crops = ["field", "glasshouse", "meadow"], ["barley", "beet", "clover", "lentil", "oat"]
    plots = [
        {
            "plot": n, "kind": kinds[n % 3], "area": {"value": round(rng.uniform(1, 40), 2), "unit": "ha"},
            "sown": [{"crop": c, "grade": rng.choice("ABC"), "kg": rng.randint(100, 900)} for c in rng.sample(crops, rng.randint(1, 3))],
        }
        for n in range(7)
    ]
    diary = {"2031": {"dry": {"note": "pump mended"}, "wet": {"note": "ditch cleared"}}, "2032": {"dry": {"note": "new gate"}}}
    return {
        "register": {"plots": plots, "keeper": {"name": "Ilka", "phone.work": "555-0100", "mail_box": "ilka@farm.test"}},
        "log": [{"from": "station", "payload": json.dumps({"seasons": diary, "sum": 3})}],
        "grid": [[{"x": 1}, {"x": 2}], [{"x": 3}]], "torn": "{not json", "none": None, "tags": ["old", "wet", 12, True, None, ["old"]],
    }


FARM = _farm(random.Random(31))
PLOTS, KEEPER = FARM["register"]["plots"], FARM["register"]["keeper"]
DIARY = json.loads(FARM["log"][0]["payload"])["seasons"]
SOWN = [s for p in PLOTS for s in p["sown"]]
CROP = SOWN[0]["crop"]
plots, sown, seasons = path("register", "plots"), Path().recurse("sown"), path("log", "payload", "seasons")


def under(value, test):
    """Values of matching keys at any depth, containers before what they hold; lists give their items."""
    found = []
    for key, inner in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        if isinstance(value, dict) and test(key):
            found += inner if isinstance(inner, list) else [inner]
        found += under(inner, test)
    return found


# a path, and what a plain walk over the document says
CASES = [
    (path("register", "keeper", "name"), KEEPER["name"]),
    (path("register", "keeper", "phone.work"), KEEPER["phone.work"]),
    (path("register", "keeper"), KEEPER),
    (path("register", "cellar"), None),
    (path("none"), None),
    (path("torn", "a"), None),
    (path("grid", "x"), [c["x"] for row in FARM["grid"] for c in row]),
    (plots.key("plot"), [p["plot"] for p in PLOTS]),
    (plots.key("area").key("unit"), [p["area"]["unit"] for p in PLOTS]),
    (plots.index(2).key("kind"), PLOTS[2]["kind"]),
    (plots.index(-2).key("kind"), PLOTS[-2]["kind"]),
    (plots.index(70), None),
    (plots.slice(1, 4).key("plot"), [1, 2, 3]),
    (plots.slice(-2, None).key("plot"), [5, 6]),
    (plots.slice(50, None), []),
    (plots.pick(0, 3, -1, 99).key("plot"), [0, 3, 6]),
    (plots.key("sown").index(0), [p["sown"][0] for p in PLOTS]),
    (path("register").keys(), list(FARM["register"])),
    (path("register", "keeper").values(), list(KEEPER.values())),
    (path("register", "keeper").index(1), KEEPER["phone.work"]),
    (path("register", "keeper").slice(1, None), dict(list(KEEPER.items())[1:])),
    (path("register", "keeper").slice(1, None).key("mail_box"), KEEPER["mail_box"]),
    (plots.slice(0, 1).keys(), list(PLOTS[0])),
    (path("log", "payload", "sum"), [3]),
    (seasons.keys(), list(DIARY)),
    (seasons.keys().slice(0, 1), list(DIARY)[:1]),
    (seasons.keys().pick(0, -1), list(DIARY)),
    (seasons.keys().where_value("*32*"), ["2032"]),
    (seasons.values().keys(), [k for year in DIARY.values() for k in year]),
    (seasons.values().values().recurse("note"), under(DIARY, lambda k: k == "note")),
    (Path().recurse("seasons").keys(), list(DIARY)),
    (Path().recurse("crop"), [s["crop"] for s in SOWN]),
    (Path().recurse("phone.work"), [KEEPER["phone.work"]]),
    (Path().recurse("*a*l*"), under(FARM, lambda k: "a" in k and "l" in k[k.index("a"):])),
    (sown.key("kg"), [s["kg"] for s in SOWN]),
    (sown.index(0).key("crop"), SOWN[0]["crop"]),
    (sown.slice(0, 2).key("kg"), [s["kg"] for s in SOWN[:2]]),
    (Path().recurse_up("unit", 1), [p["area"] for p in PLOTS]),
    (Path().recurse_up("unit", 2), PLOTS),
    (Path().recurse_up("name", 9), [FARM]),
    (path("tags").where_value("*old*"), ["old"]),
    (path("tags").where_value("/^[a-z]+$/"), ["old", "wet"]),
    (path("tags").where_value("/[open/"), None),
    (path("tags").where_value("12"), [12]),
    (path("tags").where_value("Tru"), [True]),
    (path("tags").where_value_not("old"), ["wet", 12, True, ["old"]]),
    (Path().recurse("unit").where_value_not("ha"), None),
    (plots.where_child("kind", "meadow").key("plot"), [p["plot"] for p in PLOTS if p["kind"] == "meadow"]),
    (plots.where_child_not("kind", "meadow").key("plot"), [p["plot"] for p in PLOTS if p["kind"] != "meadow"]),
    (plots.where_child("kind", "/^gl/").key("plot"), [p["plot"] for p in PLOTS if p["kind"].startswith("gl")]),
    (sown.where_child("*", "B").key("crop"), [s["crop"] for s in SOWN if "B" in (s["crop"], s["grade"], str(s["kg"]))]),
    (Path().recurse("crop").where_value(CROP).up(1).key("kg"), [s["kg"] for s in SOWN if s["crop"] == CROP]),
    (Path().recurse("crop").where_value(CROP).up(3).key("plot"), [p["plot"] for p in PLOTS for s in p["sown"] if s["crop"] == CROP]),
    (Path().recurse("*").where_child("name", "Ilka").recurse("mail_box"), [KEEPER["mail_box"]]),
]
DEEP = 150  # levels, more than a recursive search follows


def answer(df):
    text = df.select(value_json("r")).first()[0]
    return None if text is None else json.loads(text)


@pytest.mark.parametrize("at", range(len(CASES)))
def test_path(spark, at):
    expression, expected = CASES[at]
    df = spark.createDataFrame([(json.dumps(FARM),)], "body string")
    assert answer(resolve(shred_for(df, "body", expression), expression, "r")) == expected


def test_deep_documents(spark):
    document = {"end": 7}
    for _ in range(DEEP):
        document = {"k": document}
    df = spark.createDataFrame([(json.dumps(document),), ("[" * 100_000 + "5" + "]" * 100_000,)], "body string")
    whole = path(*["k"] * DEEP, "end")
    assert answer(resolve(shred_for(df.limit(1), "body", whole), whole, "r")) == 7
    trees = shred(df, "body", "json").select("tree.format", F.size("tree.nodes").alias("n")).collect()
    assert sorted((r.format, r.n) for r in trees) == [("json", DEEP + 2), ("json", 100_001)]
    near = path(*["k"] * (DEEP - 99)).recurse("end")
    assert answer(resolve(shred_for(df.limit(1), "body", near), near, "r")) == [7]
    far = Path().recurse("end")
    assert answer(resolve(shred_for(df.limit(1), "body", far), far, "r")) is None


def test_unions(spark):
    df = shred(spark.createDataFrame([('{"x": 10, "y": [20, 30]}',)], "body string"), "body").cache()
    assert answer(any_of(df, path("x"), path("z"), path("y"), out="r")) == [10, 20, 30]
    assert answer(any_of(df, path("z"), out="r")) is None
    assert answer(all_of(df, path("x"), path("y"), out="r")) == [10, 20, 30]
    assert answer(all_of(df, path("x"), path("z"), out="r")) is None
    # an empty list is a match
    assert answer(all_of(df, path("x"), path("y").slice(9, None), out="r")) == [10]


def test_schema_and_fields(spark):
    rows = [(1, '{"title": "T", "price": 9.99, "more": 1}'), (2, '[{"title": "A"}, {"price": 1}, 7]'), (3, "no json"), (4, '{"x": 1}')]
    df = spark.createDataFrame(rows, "id long, body string")
    schema = {"t": path("title"), "p": path("price"), "gone": path("nothing")}
    found = {r.id: json.loads(r.record) for r in extract_schema(shred(df, "body", "json"), schema, "id").collect()}
    assert found == {1: {"t": "T", "p": 9.99}, 2: {"t": ["A"], "p": [1]}}
    kept = sorted((r.id, -1 if r.item is None else r.item, r.filtered) for r in filter_fields(df, schema, "body").collect())
    assert kept == [
        (1, -1, '{"t": "T", "p": 9.99}'), (2, 0, '{"t": "A"}'), (2, 1, '{"p": 1}'), (2, 2, "{}"), (3, -1, "no json"), (4, -1, "{}"),
    ]


def test_fast_values_equal_slow_ones(spark):
    bodies = [
        '{"a": {"b": 1}}', '{"a": {"b": true}}', '{"a": {"b": 1.50}}', '{"a": [{"b": 1}, {"b": "x"}]}', '{"a": {"b": "{\\"c\\": 1}"}}',
        '{"a": {"b": null}}', '{"a": {"b": 1, "b": 2}}', "broken", '{"a": "{\\"b\\": 5}"}', '{"a": {"b": "plain"}}',
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    got = dict(fast_values(df, "body", path("a", "b"), "v", ("id",)).collect())
    assert got == {0: "1", 1: "True", 2: "1.5", 3: '[1, "x"]', 4: '{"c": 1}', 5: None, 6: "2", 7: None, 8: "5", 9: "plain"}


def test_pruned_documents_give_the_same_values(spark):
    rng = random.Random(7)

    def value(depth):
        kind = rng.random()
        if depth < 4 and kind < 0.4:
            return {k: value(depth + 1) for k in rng.sample("abcd", rng.randint(0, 4))}
        if depth < 4 and kind < 0.65:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        if kind < 0.75:
            return json.dumps(value(depth + 1) if depth < 4 else {"a": 1})
        return rng.choice([1, "a", "bcd", None, True, 2.5])

    rows = [(i, json.dumps(value(0))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, body string").repartition(2).cache()
    paths = [
        path("a", "b"), path("a").index(0).key("b"), path("a").slice(0, 2), path("b").where_child("a", "1").key("c"),
        Path().recurse("c"), path("a").recurse("*[bc]*"), path("a").recurse("b").key("a"), path("c").where_value_not("a"),
        Path().recurse("a").up(1).key("b"), path("d").keys(), path("a").where_child("*", "a").index(-1),
    ]
    whole = shred(df, "body", "json").cache()
    for expression in paths:
        read = lambda trees: dict(resolve(trees, expression, "r").select("id", value_json("r")).collect())
        assert read(whole) == read(shred_for(df, "body", expression, format="json"))


def test_search_for_containers_keeps_only_what_it_asks_of_them():
    reach = reach_of([Path().recurse_up("cents", 3).key("id").ops])
    doc = {"id": 1, "x": {"id": 2}, "amounts": [{"cents": 5, "name": "n", "id": 3}, {"name": "m"}], "raw": '{"code": 1}', "held": '{"\\u0063ents": 1}'}
    assert prune(doc, reach) == {"id": 1, "amounts": [{"cents": 5, "id": 3}, {}], "held": '{"\\u0063ents": 1}'}
    for expression in (Path().recurse_up("cents", 3), Path().recurse_up("cents", 3).values(), path("a").recurse_up("cents", 1).key("id")):
        assert reach_of([expression.ops]) is None


def test_documents_pruned_for_a_search_upwards_give_the_same_values(spark):
    rng = random.Random(11)

    def value(depth):
        kind = rng.random()
        if depth < 5 and kind < 0.45:
            return {k: value(depth + 1) for k in rng.sample("abcd", rng.randint(0, 4))}
        if depth < 5 and kind < 0.75:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        if kind < 0.83:
            return json.dumps(value(depth + 1) if depth < 5 else {"a": {"b": 1}})
        return rng.choice([1, "a", "{b", None, True, 2.5])

    df = spark.createDataFrame([(i, json.dumps(value(0))) for i in range(600)], "id long, body string").repartition(2).cache()
    paths = [
        Path().recurse_up("a", 1).key("b"), Path().recurse_up("b", 2).key("a"), Path().recurse_up("c", 3).key("d").key("a"),
        Path().recurse_up("*[ab]*", 2).key("c"), Path().recurse_up("d", 1).key("d"), Path().recurse_up("a", 4).key("b").key("c").key("d"),
        Path().recurse_up("a", 1), Path().recurse_up("d", 1).index(0).key("a"),
    ]
    whole = shred(df, "body", "json").cache()
    for expression in paths:
        read = lambda trees: dict(resolve(trees, expression, "r").select("id", value_json("r")).collect())
        found = read(whole)
        assert sum(v is not None for v in found.values()) > 10 and found == read(shred_for(df, "body", expression, format="json"))
