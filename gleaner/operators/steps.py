"""Path steps over shredded documents.

A ``Path`` is a chain of steps; ``resolve`` adds its result to the rows of ``shred``. Every step is
one projection over the ``tree`` column: evaluation stays inside the row and inside the JVM, so
a path costs no shuffle and no Python, and several paths share one shredding pass.

While a path is evaluated, the state is an array of groups (``mapped``, ``form``, ``els``):
one group to begin with, and one per item once a key step maps over a list. ``form`` says what the
group's value is: ONE value, a LIST of values, or a sub-DICT left by a slice. An element is a node
(``id``) or a key's text (``txt``).

The steps are written as Spark SQL expressions: one call builds a step, where composing
the same lambdas from ``Column`` objects takes hundreds of driver round trips.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import glob_to_regex, value_pattern
from .reach import reach_of
from .rows import explode_rows
from .shred import shred

ONE, LIST, DICT = 0, 1, 2
_EL = "struct<id:int,txt:string>"
_GROUP = f"struct<mapped:boolean,form:int,els:array<{_EL}>>"
_NONE = f"cast(array() as array<{_GROUP}>)"
_NO_IDS = "cast(array() as array<int>)"
_NO_TEXT = "cast(null as string)"
_SCALAR = "in ('str', 'int', 'float', 'bool')"

Sql = str
_names = itertools.count()

SEARCH_DEPTH = 100  # fixed value: how many levels a recursive search goes down


def _text(value: str) -> Sql:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lambda(fn: Callable[[Sql], Sql]) -> Sql:
    name = f"v{next(_names)}"
    return f"{name} -> {fn(name)}"


def _map(values: Sql, fn: Callable[[Sql], Sql]) -> Sql:
    return f"transform({values}, {_lambda(fn)})"


def _flat_map(values: Sql, fn: Callable[[Sql], Sql]) -> Sql:
    return f"flatten({_map(values, fn)})"


def _only(values: Sql, fn: Callable[[Sql], Sql]) -> Sql:
    return f"filter({values}, {_lambda(fn)})"


def _any(values: Sql, fn: Callable[[Sql], Sql]) -> Sql:
    return f"exists({values}, {_lambda(fn)})"


def _let(value: Sql, fn: Callable[[Sql], Sql]) -> Sql:
    """Bind an intermediate value once inside an expression."""
    return f"get({_map(f'array({value})', fn)}, 0)"


def _el(id_: Sql) -> Sql:
    return f"named_struct('id', {id_}, 'txt', {_NO_TEXT})"


def _text_el(text: Sql) -> Sql:
    return f"named_struct('id', cast(null as int), 'txt', {text})"


def _group(mapped: Sql, form: Sql | int, els: Sql) -> Sql:
    return f"named_struct('mapped', {mapped}, 'form', {form}, 'els', {els})"


def _keep_if(condition: Sql, group: Sql) -> Sql:
    """The group as a one-element array, or no group at all."""
    return f"if(coalesce({condition}, false), array({group}), {_NONE})"


def _test(value: Sql, pattern: str) -> Sql:
    test = value_pattern(pattern)
    if test is None:
        return "false"
    call = "rlike" if test[0] == "regex" else "contains"
    return f"coalesce({call}({value}, {_text(test[1])}), false)"


def _quoted(text: Sql) -> Sql:
    """JSON form of a text."""
    return _let(f"to_json(array({text}))", lambda j: f"substring({j}, 2, length({j}) - 2)")


class Tree:
    """Look-ups in the node array of one document."""

    def __init__(self, name: str = "tree", with_json: bool = True):
        self.name = name
        self.with_json = with_json
        self.nodes = f"{name}.nodes"
        self.json = f"{name}.json"

    def node(self, id_: Sql) -> Sql:
        return f"get({self.nodes}, {id_})"

    def kids(self, id_: Sql) -> Sql:
        return f"coalesce({self.node(id_)}.kids, {_NO_IDS})"

    def kind(self, id_: Sql) -> Sql:
        return f"{self.node(id_)}.kind"

    def entered(self, id_: Sql) -> Sql:
        """The root of the JSON inside a string, for other nodes the node itself."""
        return f"if({self.kind(id_)} = 'str', coalesce(get({self.kids(id_)}, 0), {id_}), {id_})"

    def is_broken_json(self, id_: Sql) -> Sql:
        return _let(
            self.node(id_),
            lambda n: f"coalesce({n}.kind = 'str' and left({n}.sval, 1) in ('{{', '[') and size({n}.kids) = 0, false)",
        )

    def below(self, id_: Sql) -> Sql:
        """The nodes of the subtree without its root, in document order."""
        return f"slice({self.nodes}, {id_} + 2, coalesce({self.node(id_)}.last - {id_}, 0))"

    def parent(self, id_: Sql) -> Sql:
        """Enclosing container (a string around embedded JSON does not count); root: itself."""
        return _let(
            f"{self.node(id_)}.parent",
            lambda p: f"coalesce(if({self.kind(p)} = 'str', {self.node(p)}.parent, {p}), {id_})",
        )

    def ancestor(self, id_: Sql, levels: int) -> Sql:
        return reduce(lambda at, _: _let(at, self.parent), range(levels), id_)

    def scalar_text(self, el: Sql) -> Sql:
        """Text that value patterns look at; null for containers and null."""
        return _let(
            self.node(f"{el}.id"),
            lambda n: f"case when {el}.id is null then {el}.txt when {n}.kind {_SCALAR} then {n}.sval end",
        )

    def is_null(self, el: Sql) -> Sql:
        return f"coalesce({self.kind(f'{el}.id')} = 'null', false)"

    def settle(self, group: Sql) -> Sql:
        """Before a step: embedded JSON is entered, a list node becomes its items; as an array
        of at most one group."""

        def one(el: Sql) -> Sql:
            as_list = lambda i: _group(f"{group}.mapped", LIST, _map(self.kids(i), _el))
            as_one = lambda i: _group(f"{group}.mapped", ONE, f"array({_el(i)})")
            settled = _let(
                self.entered(f"{el}.id"), lambda i: f"if({self.kind(i)} = 'list', {as_list(i)}, {as_one(i)})"
            )
            return (
                f"case when {el}.id is null then array({group}) "
                f"when {self.is_broken_json(f'{el}.id')} then {_NONE} else array({settled}) end"
            )

        return f"if({group}.form = {ONE}, {_let(f'get({group}.els, 0)', one)}, array({group}))"

    def items(self, group: Sql) -> Sql:
        """Ids that a mapping step visits: the value itself, or every item of the list, going
        through lists inside lists."""
        ids = _map(_only(f"{group}.els", lambda e: f"{e}.id is not null"), lambda e: self.entered(f"{e}.id"))

        def is_list(id_: Sql) -> Sql:
            return f"coalesce({self.kind(id_)} = 'list', false)"

        def open_lists(ids: Sql) -> Sql:
            return _flat_map(ids, lambda i: f"if({is_list(i)}, {_map(self.kids(i), self.entered)}, array({i}))")

        def opened(found: Sql) -> Sql:
            fold = f"aggregate(sequence(0, array_max(transform({self.nodes}, n -> n.depth))), {found}, (acc, n) -> if({_any('acc', is_list)}, {open_lists('acc')}, acc))"
            return f"if({_any(found, is_list)}, {fold}, {found})"

        # a single value has been entered by ``settle``
        return f"if({group}.form = {ONE}, array(get({group}.els, 0).id), {_let(ids, opened)})"

    def members(self, group: Sql) -> Sql:
        """Elements that a selection counts: list items, dict values; null for a scalar."""
        dict_values = _let(
            f"get({group}.els, 0).id",
            lambda i: f"case when {self.kind(i)} = 'dict' then {_map(self.kids(i), _el)} end",
        )
        return f"if({group}.form = {ONE}, {dict_values}, {group}.els)"

    def has_child(self, ids: Sql, key: str, pattern: str) -> Sql:
        """Some child with that key (a glob if it has a ``*``) has a matching value."""

        def hit(node: Sql) -> Sql:
            named = _test(f"{node}.key", key) if "*" in key else f"{node}.key = {_text(key)}"
            return f"coalesce({named} and {node}.kind {_SCALAR} and {_test(f'{node}.sval', pattern)}, false)"

        return _any(ids, lambda i: _let(self.node(i), hit))

    def item(self, el: Sql) -> Sql:
        """Result item of an element: kind, text and (unless only texts are wanted) JSON."""

        def from_node(n: Sql) -> Sql:
            cut = f"cast(substring({self.json}, {n}.at + 1, {n}.size) as string)"
            if not self.with_json:
                return _item(f"{n}.kind", f"if({n}.kind in ('dict', 'list'), {cut}, {n}.sval)", _NO_TEXT)
            return _let(cut, lambda j: _item(f"{n}.kind", f"if({n}.kind in ('dict', 'list'), {j}, {n}.sval)", j))

        from_text = _item("'str'", f"{el}.txt", _quoted(f"{el}.txt") if self.with_json else _NO_TEXT)
        return f"if({el}.id is null, {from_text}, {_let(self.node(f'{el}.id'), from_node)})"

    def sub_dict_item(self, els: Sql) -> Sql:
        whole = Tree(self.name)
        pairs = _map(els, lambda e: f"concat({_quoted(self.node(f'{e}.id') + '.key')}, ': ', {whole.item(e)}.json)")
        return _let(f"concat('{{', array_join({pairs}, ', '), '}}')", lambda t: _item("'dict'", t, t))


def _item(kind: Sql, text: Sql, json_text: Sql) -> Sql:
    return f"named_struct('kind', {kind}, 'text', {text}, 'json', {json_text})"


StepFn = Callable[[Tree, Sql], Sql]  # (tree, settled group) -> array of groups


@dataclass(frozen=True)
class Path:
    """A chain of steps. Every method returns a longer path; nothing is evaluated."""

    steps: tuple[StepFn, ...] = ()
    ops: tuple[tuple[str, Any], ...] = ()  # (step, argument), tells what the path can reach
    plain: tuple[str | int, ...] | None = ()  # keys and indexes only, for the variant reader
    calls: tuple[tuple[str, tuple], ...] = ()  # (method, arguments), what other evaluators compile

    def _then(self, step: StepFn, op: str, arg: Any = None, plain: str | int | None = None, call: tuple | None = None) -> Path:
        kept = None if plain is None or self.plain is None else self.plain + (plain,)
        return Path(self.steps + (step,), self.ops + ((op, arg),), kept, self.calls + (call or (op, (arg,)),))

    # -- navigation: maps over lists -------------------------------------------------

    def key(self, name: str) -> Path:
        """Child by key; the name is taken literally, whatever characters it holds."""

        def step(tree: Tree, group: Sql) -> Sql:
            mapped = f"({group}.mapped or {group}.form = {LIST})"
            of_items = _flat_map(tree.items(group), tree.kids)
            candidates = f"if({group}.form = {DICT}, {_map(f'{group}.els', lambda e: f'{e}.id')}, {of_items})"
            wanted = lambda n: f"{n}.key = {_text(name)} and {n}.kind != 'null'"
            found = _only(candidates, lambda i: f"coalesce({_let(tree.node(i), wanted)}, false)")
            return _map(found, lambda i: _group(mapped, ONE, f"array({_el(i)})"))

        return self._then(step, "key", name, plain=name)

    def _each_dict(self, to_el: Callable[[Tree, Sql], Sql], call: str) -> Path:
        def step(tree: Tree, group: Sql) -> Sql:
            mapped = f"({group}.mapped or {group}.form = {LIST})"
            dicts = _only(tree.items(group), lambda i: f"{tree.kind(i)} = 'dict'")
            per_item = _map(dicts, lambda i: _group(mapped, LIST, _map(tree.kids(i), lambda k: to_el(tree, k))))
            of_sub_dict = _group(mapped, LIST, _map(f"{group}.els", lambda e: to_el(tree, f"{e}.id")))
            return f"if({group}.form = {DICT}, array({of_sub_dict}), {per_item})"

        return self._then(step, "all", call=(call, ()))

    def keys(self) -> Path:
        """The keys of a dict as a list."""
        return self._each_dict(lambda tree, k: _text_el(f"{tree.node(k)}.key"), "keys")

    def values(self) -> Path:
        """The values of a dict as a list."""
        return self._each_dict(lambda tree, k: _el(k), "values")

    def _recurse(self, name: str, up: int) -> Path:
        test = f"rlike({{}}, {_text(glob_to_regex(name))})" if "*" in name else f"{{}} = {_text(name)}"

        def named(key: Sql) -> Sql:
            return f"coalesce({test.replace('{}', key, 1)}, false)"

        def step(tree: Tree, group: Sql) -> Sql:
            starts = _map(_only(f"{group}.els", lambda e: f"{e}.id is not null"), lambda e: f"{e}.id")

            def hits(start: Sql) -> Sql:
                near = lambda n: f"{n}.depth - {tree.node(start)}.depth <= {SEARCH_DEPTH}"
                inner = _map(_only(tree.below(start), lambda n: f"{named(f'{n}.key')} and {near(n)}"), lambda n: f"{n}.id")
                own = f"{group}.form = {DICT} and {named(f'{tree.node(start)}.key')}"
                return f"if({own}, concat(array({start}), {inner}), {inner})"

            def above(start: Sql) -> Sql:
                outermost = _let(
                    tree.parent(start),
                    lambda p: f"if({group}.form = {LIST} and {tree.kind(p)} = 'list', {p}, {start})",
                )
                return _let(
                    outermost, lambda top: _map(hits(start), lambda i: f"greatest({tree.ancestor(i, up)}, {top})")
                )

            def flat(start: Sql) -> Sql:
                return _flat_map(hits(start), lambda i: f"if({tree.kind(i)} = 'list', {tree.kids(i)}, array({i}))")

            return _let(
                _flat_map(starts, above if up else flat),
                lambda found: _keep_if(f"size({found}) > 0", _group(f"{group}.mapped", LIST, _map(found, _el))),
            )

        return self._then(step, "up" if up else "recurse", name, call=("recurse", (name, up)))

    def recurse(self, name: str) -> Path:
        """Every value under that key (a glob if it has a ``*``) at any depth, in document
        order; a list contributes its items."""
        return self._recurse(name, 0)

    def recurse_up(self, name: str, levels: int) -> Path:
        """The containers ``levels`` above every such value; 1 is the dict that holds the key."""
        return self._recurse(name, max(levels, 1))

    # -- selection -------------------------------------------------------------------

    def index(self, at: int) -> Path:
        """One item of a list, or one value of a dict by key position; negative from the end."""

        def step(tree: Tree, group: Sql) -> Sql:
            where = lambda els: str(at) if at >= 0 else f"size({els}) - {-at}"
            chosen = lambda el: _keep_if(f"{el} is not null", _group(f"{group}.mapped", ONE, f"array({el})"))
            return _let(tree.members(group), lambda els: _let(f"get({els}, {where(els)})", chosen))

        return self._then(step, "select", plain=at if at >= 0 else None, call=("index", (at,)))

    def pick(self, *positions: int) -> Path:
        """Several items in the given order; positions out of range are left out."""

        def step(tree: Tree, group: Sql) -> Sql:
            wanted = f"array({', '.join(map(str, positions))})"

            def picked(els: Sql) -> Sql:
                found = _map(wanted, lambda p: f"get({els}, if({p} >= 0, {p}, size({els}) + {p}))")
                return _let(
                    _only(found, lambda el: f"{el} is not null"),
                    lambda kept: _keep_if(f"size({kept}) > 0", _group(f"{group}.mapped", LIST, kept)),
                )

            return _let(tree.members(group), picked)

        return self._then(step, "select", call=("pick", positions))

    def slice(self, start: int | None = None, stop: int | None = None) -> Path:
        """Half-open range, open or negative ends allowed; a dict keeps a sub-dict."""

        def bound(value: int | None, default: Sql, size: Sql) -> Sql:
            if value is None:
                return default
            return f"least({value}, {size})" if value >= 0 else f"greatest({size} - {-value}, 0)"

        def step(tree: Tree, group: Sql) -> Sql:
            def cut(els: Sql) -> Sql:
                size = f"size({els})"
                low, high = bound(start, "0", size), bound(stop, size, size)
                part = f"slice({els}, {low} + 1, greatest({high} - {low}, 0))"
                form = f"if({group}.form = {LIST}, {LIST}, {DICT})"
                return _keep_if(f"{els} is not null", _group(f"{group}.mapped", form, part))

            return _let(tree.members(group), cut)

        return self._then(step, "select", call=("slice", (start, stop)))

    # -- filters ---------------------------------------------------------------------

    def _where(
        self, keep_el: Callable[[Tree, Sql], Sql], keep_dict: Callable[[Tree, Sql], Sql], op: str, arg: Any, call: tuple
    ) -> Path:
        def step(tree: Tree, group: Sql) -> Sql:
            filtered = _let(
                _only(f"{group}.els", lambda e: f"coalesce({keep_el(tree, e)}, false)"),
                lambda els: _keep_if(f"size({els}) > 0", _group(f"{group}.mapped", f"{group}.form", els)),
            )
            return f"if({group}.form = {DICT}, {_keep_if(keep_dict(tree, group), group)}, {filtered})"

        return self._then(step, op, arg, call=call)

    def where_value(self, pattern: str) -> Path:
        """Keep scalars that match; containers and null never do."""
        return self._where(
            lambda tree, e: _test(tree.scalar_text(e), pattern), lambda tree, g: "false", "where_value", None, ("where_value", (pattern,))
        )

    def where_value_not(self, pattern: str) -> Path:
        """Keep values that do not match, containers included; null goes."""
        return self._where(
            lambda tree, e: f"not {tree.is_null(e)} and not {_test(tree.scalar_text(e), pattern)}",
            lambda tree, g: "true",
            "where_value",
            None,
            ("where_value_not", (pattern,)),
        )

    def _where_child(self, key: str, pattern: str, sign: str) -> Path:
        return self._where(
            lambda tree, e: f"{tree.kind(f'{e}.id')} = 'dict' and {sign} {tree.has_child(tree.kids(f'{e}.id'), key, pattern)}",
            lambda tree, g: f"{sign} {tree.has_child(_map(f'{g}.els', lambda e: f'{e}.id'), key, pattern)}",
            "where_child",
            key,
            ("where_child", (key, pattern, sign)),
        )

    def where_child(self, key: str, pattern: str) -> Path:
        """Keep dicts that have a child ``key`` (a glob if it has a ``*``) whose value matches."""
        return self._where_child(key, pattern, "")

    def where_child_not(self, key: str, pattern: str) -> Path:
        """Keep dicts without such a child."""
        return self._where_child(key, pattern, "not")

    # -- context ---------------------------------------------------------------------

    def up(self, levels: int) -> Path:
        """Containers ``levels`` above the current values, in document order, one per value;
        the root when there are fewer levels."""

        def step(tree: Tree, group: Sql) -> Sql:
            ids = _map(_only(f"{group}.els", lambda e: f"{e}.id is not null"), lambda e: f"{e}.id")
            found = _map(f"array_sort(array_distinct({ids}))", lambda i: _el(tree.ancestor(i, levels)))
            return _keep_if(f"size({ids}) > 0 and {group}.form != {DICT}", _group(f"{group}.mapped", LIST, found))

        return self._then(step, "up", call=("up", (levels,)))


def path(*keys: str) -> Path:
    """A path that starts at the document's root and goes down the given keys."""
    return reduce(Path.key, keys, Path())


def _closed(tree: Tree, group: Sql) -> Sql:
    """(is_list, items) of one group; a JSON string becomes what it holds."""

    def pair(is_list: str, items: Sql) -> Sql:
        return f"named_struct('l', {is_list}, 'v', {items})"

    def one(el: Sql) -> Sql:
        listed = lambda i: pair("true", _map(tree.kids(i), lambda k: tree.item(_el(k))))
        single = lambda i: pair("false", f"array({tree.item(_el(i))})")
        node = _let(
            tree.entered(f"{el}.id"),
            lambda i: f"case {tree.kind(i)} when 'list' then {listed(i)} when 'null' then null else {single(i)} end",
        )
        return f"if({el}.id is null, {pair('false', f'array({tree.item(el)})')}, {node})"

    return (
        f"case {group}.form when {ONE} then {_let(f'get({group}.els, 0)', one)} "
        f"when {LIST} then {pair('true', _map(f'{group}.els', tree.item))} "
        f"else {pair('false', f'array({tree.sub_dict_item(f"{group}.els")})')} end"
    )


def shred_for(
    df: DataFrame,
    body: str,
    *paths: Path,
    format: str | None = None,
    keep: Iterable[str] | None = None,
    split_lists: bool = False,
) -> DataFrame:
    """``shred`` for the given paths only: the parts of a document that none of them can reach are
    dropped right after parsing."""
    reach = reach_of([p.ops for p in paths])
    return shred(df, body, format, keep, split_lists, reach=reach)


def resolve(df: DataFrame, expression: Path, out: str, tree: str = "tree", with_json: bool = True) -> DataFrame:
    """Add the path's result as ``struct<is_list, items: array<struct<kind, text, json>>>``, null
    where nothing matched. An empty list is a match. ``with_json=False`` leaves ``json`` empty
    where only the texts are wanted."""
    at, state = Tree(tree, with_json), f"__state_{out}"
    root = _group("false", ONE, f"array({_el('0')})")
    df = df.withColumn(state, F.expr(f"if(size({at.nodes}) > 0, array({root}), {_NONE})"))
    for step in expression.steps:
        df = df.withColumn(state, F.expr(_flat_map(state, at.settle)))
        df = df.withColumn(state, F.expr(_flat_map(state, lambda g: step(at, g))))
    closed = _map(state, lambda g: f"named_struct('mapped', {g}.mapped, 'c', {_closed(at, g)})")
    df = df.withColumn(state, F.expr(_only(closed, lambda p: f"{p}.c is not null")))
    mapped = _any(state, lambda p: f"{p}.mapped")
    is_list = f"{mapped} or {_any(state, lambda p: f'{p}.c.l')}"
    items = _flat_map(state, lambda p: f"{p}.c.v")
    hit = f"size({state}) > 0 and (not {mapped} or {_any(state, lambda p: f'size({p}.c.v) > 0')})"
    result = f"case when {hit} then named_struct('is_list', {is_list}, 'items', {items}) end"
    return df.withColumn(out, F.expr(result)).drop(state)


def _combine(df: DataFrame, expressions: tuple[Path, ...], out: str, tree: str, every: bool) -> DataFrame:
    names = [f"__part{i}_{out}" for i in range(len(expressions))]
    for name, expression in zip(names, expressions):
        df = resolve(df, expression, name, tree)
    found = _only(f"array({', '.join(names)})", lambda r: f"{r} is not null")
    enough = f"size({found}) = {len(names)}" if every else "true"
    items = _flat_map(found, lambda r: f"{r}.items")
    combined = f"case when {enough} and size({items}) > 0 then named_struct('is_list', true, 'items', {items}) end"
    return df.withColumn(out, F.expr(combined)).drop(*names)


def any_of(df: DataFrame, *expressions: Path, out: str, tree: str = "tree") -> DataFrame:
    """Union of the values of several paths, in path order; null when there are none."""
    return _combine(df, expressions, out, tree, every=False)


def all_of(df: DataFrame, *expressions: Path, out: str, tree: str = "tree") -> DataFrame:
    """Like ``any_of``, but null unless every path matched."""
    return _combine(df, expressions, out, tree, every=True)


def value_json(result: str) -> Column:
    """A result as JSON: a list if it is one, else the single value; null when unmatched."""
    joined = f"concat('[', array_join({result}.items.json, ', '), ']')"
    return F.expr(f"if({result}.is_list, {joined}, get({result}.items, 0).json)")


def value_text(result: str) -> Column:
    """A result as one cell of text: scalars as they are, containers and lists as JSON."""
    return F.when(F.col(f"{result}.is_list"), value_json(result)).otherwise(F.expr(f"get({result}.items, 0).text"))


def explode_values(df: DataFrame, result: str, *ids: str) -> DataFrame:
    """One row per value: the given columns, the value's ordinal ``ord``, ``kind`` and ``value``.

    Null values are left out; containers come as JSON text.
    """
    items = F.expr(f"filter({result}.items, i -> i.kind != 'null')")
    return explode_rows(df, ids, items, "__item", "ord").select(
        *ids, "ord", F.col("__item.kind").alias("kind"), F.col("__item.text").alias("value")
    )


def extract_values(df: DataFrame, expression: Path, *ids: str, tree: str = "tree") -> DataFrame:
    """One row per value of a path."""
    return explode_values(resolve(df, expression, "__values", tree, with_json=False), "__values", *ids)


def _record(df: DataFrame, schema: Mapping[str, Path], tree: str, out: str) -> DataFrame:
    """``{name: value}`` as one JSON object without the unmatched names; null if none matched."""
    pairs, parts = [], []
    for i, (name, expression) in enumerate(schema.items()):
        part = f"__field{i}"
        df = resolve(df, expression, part, tree)
        parts.append(part)
        pairs.append(F.concat(F.lit(json.dumps(name, ensure_ascii=False) + ": "), value_json(part)))
    df = df.withColumn("__pairs", F.array_compact(F.array(*pairs)))
    record = F.concat(F.lit("{"), F.array_join("__pairs", ", "), F.lit("}"))
    return df.withColumn(out, F.when(F.size("__pairs") > 0, record)).drop("__pairs", *parts)


def extract_schema(
    df: DataFrame, schema: Mapping[str, Path], *ids: str, tree: str = "tree", out: str = "record"
) -> DataFrame:
    """One JSON record per document that matches at least one of the named paths."""
    records = _record(df, schema, tree, out).withColumn("__found", F.array_compact(F.array(out)))
    return explode_rows(records.drop(out), ids, F.col("__found"), out)


def filter_fields(df: DataFrame, schema: Mapping[str, Path], body: str, out: str = "filtered") -> DataFrame:
    """Keep the named paths of JSON payloads.

    A list document gives one row per item, numbered by ``item`` (null for other documents);
    ``{}`` stands for a value without any of the fields, and a payload that is no
    JSON comes back unchanged.
    """
    source = df.withColumn("__payload", F.col(body))
    split = shred_for(source, "__payload", *schema.values(), format="json", split_lists=True)
    whole = F.col("tree.format").isNull()
    return (
        _record(split, schema, "tree", out)
        .withColumn(out, F.when(whole, F.col(body).cast("string")).otherwise(F.coalesce(out, F.lit("{}"))))
        .drop("tree", body)
    )


def fast_values(df: DataFrame, body: str, expression: Path, out: str, keep: tuple[str, ...]) -> DataFrame:
    """Text of a keys-and-indexes path over JSON payloads, without shredding where possible.

    A string or whole number found by the variant reader is final; only the other rows carry
    their payload on to the shredder, in the same pass. Same results as ``resolve``.
    """
    if expression.plain is None:
        raise ValueError("only keys and non-negative indexes have a variant form")
    steps = "".join(f"[{p}]" if isinstance(p, int) else f"['{_variant_key(p)}']" for p in expression.plain)
    found = F.try_variant_get(F.try_parse_json(body), "$" + steps, "variant")
    quick = F.when(
        F.schema_of_variant(found).isin("STRING", "BIGINT")
        & ~F.coalesce(F.try_variant_get(found, "$", "string").rlike(r"\A[{\[]"), F.lit(False)),
        F.try_variant_get(found, "$", "string"),
    )
    probed = df.select(*keep, body, quick.alias("__quick"))
    rest = probed.select(*keep, "__quick", F.when(F.col("__quick").isNull(), F.col(body)).alias("__rest"))
    shredded = resolve(shred_for(rest, "__rest", expression, format="json"), expression, "__slow")
    return shredded.select(*keep, F.coalesce("__quick", value_text("__slow")).alias(out))


def _variant_key(key: str) -> str:
    if "'" in key:
        raise ValueError("a key with a quote has no variant form")
    return key
