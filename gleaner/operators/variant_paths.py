"""Paths compiled to expressions over VARIANT: JSON payloads are queried without a tree and without Python.

``resolve_json`` gives the same result column as ``steps.resolve``. A payload is parsed once to a
VARIANT; a key or an index is one look-up in it, filters are higher-order functions over
its arrays, and a search is a fold that goes down level by level inside the row. Nothing is
joined or shuffled.

A VARIANT sorts the keys of its objects, so an element also knows where it stands (``at``: position and key, from
the root down). Where order shows - the keys of a dict, a dict taken by position, a container as text - it is read from the
payload's own text at that place, by Spark's JSON functions. States are built as in ``steps``; elements are
``v`` (the value), ``at`` and ``txt`` (a key's text, without a value).

A payload that holds a key twice in one object, nests deeper than 1,000 levels or exceeds the size of a
VARIANT counts as no JSON here (unless the session allows repeated keys); ``steps.shred_for`` reads such documents.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import strict_json_sql, with_strict_json
from ..functions.text import glob_to_regex
from .rows import explode_rows, spread_costly
from .steps import (
    DICT, LIST, ONE, SEARCH_DEPTH, Path, Sql, _any, _flat_map, _item, _keep_if, _let, _map, _only, _quoted, _test, _text,
    explode_values, value_json,
)

_STEP = "struct<i:int,k:string>"
_EL = f"struct<v:variant,at:array<{_STEP}>,txt:string>"
_GROUP = f"struct<mapped:boolean,form:int,els:array<{_EL}>>"
_NONE = f"cast(array() as array<{_GROUP}>)"
_NO_ELS = f"cast(array() as array<{_EL}>)"
_ROOT = f"cast(array() as array<{_STEP}>)"
_NESTING = 1000  # levels that Spark's JSON parser goes down: a fixed value


def _el(value: Sql, at: Sql) -> Sql:
    return f"named_struct('v', {value}, 'at', {at}, 'txt', cast(null as string))"


def _text_el(text: Sql) -> Sql:
    return f"named_struct('v', cast(null as variant), 'at', {_ROOT}, 'txt', {text})"


def _group(mapped: Sql, form: Sql | int, els: Sql) -> Sql:
    return f"named_struct('mapped', {mapped}, 'form', {form}, 'els', {els})"


def _below(at: Sql, place: Sql | int, key: Sql) -> Sql:
    """The place of a child."""
    return f"concat({at}, array(named_struct('i', cast({place} as int), 'k', cast({key} as string))))"


def _key_of(el: Sql) -> Sql:
    return f"element_at({el}.at, -1).k"


# -- values ------------------------------------------------------------------------------


def _items(value: Sql) -> Sql:
    """The items of a list, null for any other value."""
    return f"try_variant_get({value}, '$', 'array<variant>')"


def _is_list(value: Sql) -> Sql:
    # items asked for as structs are not copied
    return f"(try_variant_get({value}, '$', 'array<struct<`-`:variant>>') is not null)"


def _is_dict(value: Sql) -> Sql:
    return f"(try_variant_get({value}, '$', 'struct<`-`:variant>') is not null)"


def _is_null(value: Sql) -> Sql:
    return f"coalesce(is_variant_null({value}), false)"


def _child(value: Sql, key: str) -> Sql:
    """A dict's value by a key known beforehand."""
    if "'" in key or "?" in key or "\\" in key or not key:
        return f"element_at(try_variant_get({value}, '$', 'map<string,variant>'), {_text(key)})"
    return f"""try_variant_get({value}, "$['{key.replace('"', '\\"')}']", 'variant')"""


def _child_of(value: Sql, key: Sql) -> Sql:
    """A dict's value by a key of the row."""
    by_path = f"""try_variant_get({value}, concat("$['", {key}, "']"), 'variant')"""
    by_map = f"element_at(try_variant_get({value}, '$', 'map<string,variant>'), {key})"
    return f"""if({key} = '' or rlike({key}, "['?\\\\\\\\]"), {by_map}, {by_path})"""


def _holds_json(value: Sql) -> Sql:
    """Whether a scalar is a text that starts like JSON."""
    text = f"left(try_variant_get({value}, '$', 'string'), 1)"
    return f"(not {_is_list(value)} and not {_is_dict(value)} and coalesce({text} in ('{{', '['), false))"


def _entered(value: Sql) -> Sql:
    """What the JSON inside a text holds (null if it is none); other values as they are."""
    text = f"try_variant_get({value}, '$', 'string')"
    return f"if({_holds_json(value)}, {strict_json_sql(text)}, {value})"


def _entered_or_self(value: Sql) -> Sql:
    return f"coalesce({_entered(value)}, {value})"


def _kind(value: Sql) -> Sql:
    return (
        f"case when {value} is null then null when {_is_null(value)} then 'null' when {_is_list(value)} then 'list' "
        f"when {_is_dict(value)} then 'dict' else {_let(f'schema_of_variant({value})', _scalar_kind)} end"
    )


def _scalar_kind(kind: Sql) -> Sql:
    # a whole number beyond a long is a decimal of more than 18 digits
    whole = f"{kind} in ('BIGINT', 'INT', 'SMALLINT', 'TINYINT') or rlike({kind}, '^DECIMAL[(](19|[23][0-9]),0[)]$')"
    return f"case when {kind} = 'STRING' then 'str' when {kind} = 'BOOLEAN' then 'bool' when {whole} then 'int' else 'float' end"


def float_text(number: Sql) -> Sql:
    """A double's text without exponent from 1e-4 up to below 1e16; the digits are the JVM's (before Java 19 of 16 and more digits
    sometimes one too many)."""
    plain = _let(
        f"rtrim('0', cast(cast({number} as decimal(38,22)) as string))", lambda t: f"if(endswith({t}, '.'), concat({t}, '0'), {t})"
    )
    power = f"cast(substring_index({number}, 'E', -1) as int)"
    digits = f"regexp_replace(substring_index({number}, 'E', 1), '[.]0$', '')"
    short = f"concat({digits}, 'e', if({power} < 0, '-', '+'), if(abs({power}) < 10, '0', ''), cast(abs({power}) as string))"
    return f"case when not contains({number}, 'E') then {number} when {power} >= -4 and {power} < 16 then {plain} else {short} end"


def _scalar_text(value: Sql, kind: Sql) -> Sql:
    number = f"cast(try_variant_get({value}, '$', 'double') as string)"
    return (
        f"case {kind} when 'bool' then if(try_variant_get({value}, '$', 'boolean'), 'True', 'False') "
        f"when 'float' then {_let(number, float_text)} when 'null' then '' else try_variant_get({value}, '$', 'string') end"
    )


def _value_text(value: Sql) -> Sql:
    """Text of a scalar; null for containers and null."""
    return _let(
        _kind(value), lambda k: f"case when {k} in ('str', 'int', 'float', 'bool') then {_scalar_text(value, k)} end"
    )


# -- texts -------------------------------------------------------------------------------


def _text_below(text: Sql, step: Sql) -> Sql:
    """A child's text; a text that holds JSON stands there as that JSON."""
    return f"if({step}.k is null, get(from_json({text}, 'array<string>'), {step}.i), element_at(from_json({text}, 'map<string,string>'), {step}.k))"


def _text_at(body: Sql, at: Sql) -> Sql:
    """The payload's own text at a place."""
    return f"aggregate({at}, {body}, (t, s) -> {_text_below('t', 's')})"


def spaced(text: Sql) -> Sql:
    """JSON text with one blank after every comma and colon, none elsewhere, and floats as ``float_text`` gives them.

    Quotes split the text into what lies outside and inside of strings; escaped quotes and backslashes are put aside first, as
    characters that JSON text cannot hold.
    """
    aside = f"replace(replace({text}, '\\\\\\\\', '\\u0001'), '\\\\\"', '\\u0002')"
    number = lambda x: f"if(rlike({x}, '^-?[0-9.]+E'), {float_text(x)}, {x})"
    exact = lambda p: f"array_join({_map(f'regexp_extract_all({p}, "[^,:\\\\[\\\\]{{}}]+|[,:\\\\[\\\\]{{}}]", 0)', number)}, '')"
    outside = lambda p: f"replace(replace(if(contains({p}, 'E'), {exact(p)}, {p}), ',', ', '), ':', ': ')"
    parts = f"transform(split({aside}, '\"', -1), (p, n) -> if(n % 2 = 0, {outside('p')}, p))"
    return f"replace(replace(array_join({parts}, '\"'), '\\u0002', '\\\\\"'), '\\u0001', '\\\\\\\\')"


def _container_text(body: Sql, at: Sql) -> Sql:
    return _let(f"get_json_object({_text_at(body, at)}, '$')", spaced)


# -- the evaluator -------------------------------------------------------------------------


class Payload:
    """Look-ups in one parsed payload: ``value`` names its VARIANT, ``body`` its text."""

    def __init__(self, value: Sql, body: Sql, with_json: bool = True, texts: bool = True):
        self.value, self.body, self.with_json, self.texts = value, body, with_json, texts

    def named(self, el: Sql) -> Sql:
        """The children of a dict in the order of its text, null for other values."""
        keys = f"json_object_keys(get_json_object({_text_at(self.body, f'{el}.at')}, '$'))"
        child = lambda m: f"(k, i) -> {_el(f'element_at({m}, k)', _below(f'{el}.at', 'i', 'k'))}"
        of_map = lambda m: f"if({m} is null, null, transform(coalesce({keys}, array()), {child(m)}))"
        return _let(f"try_variant_get({el}.v, '$', 'map<string,variant>')", of_map)

    def listed(self, value: Sql, at: Sql) -> Sql:
        """The items of a list as elements."""
        return f"transform({_items(value)}, (x, i) -> {_el('x', _below(at, 'i', 'null'))})"

    def settle(self, group: Sql) -> Sql:
        """Before a step: JSON in a text is entered, a list becomes its items; at most one group."""

        def inside(el: Sql, value: Sql) -> Sql:
            as_list = _group(f"{group}.mapped", LIST, self.listed(value, f"{el}.at"))
            as_one = _group(f"{group}.mapped", ONE, f"array({_el(value, f'{el}.at')})")
            return f"case when {value} is null then {_NONE} when {_is_list(value)} then array({as_list}) else array({as_one}) end"

        def one(el: Sql) -> Sql:
            return f"if({el}.v is null, array({group}), {_let(_entered(f'{el}.v'), lambda v: inside(el, v))})"

        return f"if({group}.form = {ONE}, {_let(f'get({group}.els, 0)', one)}, array({group}))"

    def visited(self, group: Sql) -> Sql:
        """What a mapping step visits: the value itself, or every item, through lists inside lists."""
        entered = lambda e: _el(_entered_or_self(f"{e}.v"), f"{e}.at")
        own = _map(_only(f"{group}.els", lambda e: f"{e}.v is not null"), entered)
        is_list = lambda e: _is_list(f"{e}.v")

        def opened(found: Sql) -> Sql:
            open_one = lambda e: f"if({is_list(e)}, {_map(self.listed(f'{e}.v', f'{e}.at'), entered)}, array({e}))"
            fold = f"aggregate(sequence(1, {_NESTING}), {found}, (acc, n) -> if({_any('acc', is_list)}, {_flat_map('acc', open_one)}, acc))"
            return f"if({_any(found, is_list)}, {fold}, {found})"

        return f"if({group}.form = {ONE}, {group}.els, {_let(own, opened)})"

    def members(self, group: Sql) -> Sql:
        """What a selection counts: list items, dict values; null for a scalar."""
        return f"if({group}.form = {ONE}, {_let(f'get({group}.els, 0)', self.named)}, {group}.els)"

    def found(self, start: Sql, test: Callable[[Sql], Sql]) -> Sql:
        """The elements below ``start`` whose key passes, in document order: a fold over the levels of the subtree."""
        named = f"array<struct<v:variant,at:array<{_STEP}>,own:boolean>>"
        node = lambda v, at, own: f"named_struct('v', {v}, 'at', {at}, 'own', {own})"
        of_list = lambda e: f"transform({_items(f'{e}.v')}, (x, i) -> {node('x', _below(f'{e}.at', 'i', 'null'), 'true')})"
        pairs = lambda e: f"try_variant_get({e}.v, '$', 'map<string,variant>')"
        of_dict = lambda e: f"transform(map_entries({pairs(e)}), x -> {node('x.value', _below(f'{e}.at', -1, 'x.key'), 'true')})"
        # a text is entered in a step of its own; its element is the text
        text = lambda e: f"try_variant_get({e}.v, '$', 'string')"
        of_text = lambda e: _let(
            strict_json_sql(text(e)), lambda v: f"if({v} is null, cast(array() as {named}), array({node(v, f'{e}.at', 'false')}))"
        )
        children = lambda e: (
            f"case when {_is_list(f'{e}.v')} then {of_list(e)} when {_is_dict(f'{e}.v')} then {of_dict(e)} "
            f"when left({text(e)}, 1) in ('{{', '[') then {of_text(e)} else cast(array() as {named}) end"
        )
        hit = lambda e: f"{e}.own and coalesce({test(_key_of(e))}, false)"
        as_el = lambda e: _el(f"{e}.v", f"{e}.at")
        # every round takes the hits of the level it opens, so that a level is looked at once
        step = f"named_struct('open', {_flat_map('acc.open', children)}, 'hits', concat(acc.hits, {_map(_only('acc.open', hit), as_el)}))"
        begin = f"named_struct('open', array({node(f'{start}.v', f'{start}.at', 'false')}), 'hits', {_NO_ELS})"
        folded = f"aggregate(sequence(0, {SEARCH_DEPTH}), {begin}, (acc, n) -> if(size(acc.open) = 0, acc, {step}), acc -> acc.hits)"
        return _let(folded, self.ordered)

    def ordered(self, els: Sql) -> Sql:
        """Elements in document order. Where all go down the same keys, positions in lists tell; else the positions of the keys
        are read from the text."""
        by = lambda key: f"(a, b) -> case when {key('a')} < {key('b')} then -1 when {key('a')} > {key('b')} then 1 else 0 end"
        alike = f"size(array_distinct({_map(els, lambda e: f'transform({e}.at, s -> s.k)')})) <= 1"
        placed = _map(els, lambda e: f"named_struct('e', {e}, 'p', {self.positions(f'{e}.at')})")
        sorted_ = f"transform(array_sort({placed}, {by(lambda x: f'{x}.p')}), x -> x.e)"
        return f"case when size({els}) <= 1 then {els} when {alike} then array_sort({els}, {by(lambda x: f'{x}.at')}) else {sorted_} end"

    def positions(self, at: Sql) -> Sql:
        """A place as positions only: a list's index, a key's number among the keys of its dict."""
        keys = "json_object_keys(get_json_object(acc.t, '$'))"
        number = f"if(s.k is null, s.i, cast(array_position({keys}, s.k) as int))"
        begin = f"named_struct('t', {self.body}, 'p', cast(array() as array<int>))"
        return f"aggregate({at}, {begin}, (acc, s) -> named_struct('t', {_text_below('acc.t', 's')}, 'p', concat(acc.p, array({number}))), acc -> acc.p)"

    def at(self, place: Sql) -> Sql:
        """The element at a place, from the root down."""
        down = lambda v, s: f"if({s}.k is null, get({_items(v)}, {s}.i), {_child_of(v, f'{s}.k')})"
        value = f"aggregate({place}, {self.value}, (v, s) -> {_let(_entered('v'), lambda w: down(w, 's'))})"
        return _el(_let(value, _entered_or_self), place)

    def item(self, el: Sql) -> Sql:
        """Result item of an element: kind, text and (unless only texts are wanted) JSON."""

        def from_value(kind: Sql) -> Sql:
            container = _let(_container_text(self.body, f"{el}.at"), lambda t: _item(kind, t, t if self.with_json else "cast(null as string)"))
            text = _scalar_text(f"{el}.v", kind)
            as_json = lambda t: f"case {kind} when 'str' then {_quoted(t)} when 'bool' then lower({t}) when 'null' then 'null' else {t} end"
            scalar = _let(text, lambda t: _item(kind, t, as_json(t) if self.with_json else "cast(null as string)"))
            return f"if({kind} in ('dict', 'list'), {container}, {scalar})"

        of_value = _let(_kind(f"{el}.v"), from_value)
        if not self.texts:
            return of_value
        from_text = _item("'str'", f"{el}.txt", _quoted(f"{el}.txt") if self.with_json else "cast(null as string)")
        return f"if({el}.v is null, {from_text}, {of_value})"

    def sub_dict_item(self, els: Sql) -> Sql:
        whole = Payload(self.value, self.body)
        pairs = _map(els, lambda e: f"concat({_quoted(_key_of(e))}, ': ', {whole.item(e)}.json)")
        return _let(f"concat('{{', array_join({pairs}, ', '), '}}')", lambda t: _item("'dict'", t, t))

    def closed(self, group: Sql, texts: bool) -> Sql:
        """A group with its value opened at last: ``l``, whether it is a list, and its elements; a text that holds JSON becomes
        what it holds, null goes."""
        pair = lambda form, is_list, els: f"named_struct('mapped', {group}.mapped, 'form', {form}, 'l', {is_list}, 'els', {els})"

        def inside(el: Sql, value: Sql) -> Sql:
            listed = pair(LIST, "true", self.listed(value, f"{el}.at"))
            return f"case when {_is_list(value)} then {listed} when {_is_null(value)} then null else {pair(ONE, 'false', f'array({_el(value, f"{el}.at")})')} end"

        def one(el: Sql) -> Sql:
            opened = _let(_entered_or_self(f"{el}.v"), lambda v: inside(el, v))
            return f"if({el}.v is null, {pair(ONE, 'false', f'array({el})')}, {opened})" if texts else opened

        return f"if({group}.form = {ONE}, {_let(f'get({group}.els, 0)', one)}, {pair(f'{group}.form', f'{group}.form = {LIST}', f'{group}.els')})"


# -- the steps: (payload, settled group) -> groups ------------------------------------------


def _mapped(group: Sql) -> Sql:
    return f"({group}.mapped or {group}.form = {LIST})"


def _key(p: Payload, group: Sql, name: str) -> Sql:
    below = lambda e: _let(_child(f"{e}.v", name), lambda c: f"if({c} is null, {_NO_ELS}, array({_el(c, _below(f'{e}.at', -1, _text(name)))}))")
    of_items = _flat_map(p.visited(group), below)
    of_sub_dict = _only(f"{group}.els", lambda e: f"{_key_of(e)} = {_text(name)}")
    found = _only(f"if({group}.form = {DICT}, {of_sub_dict}, {of_items})", lambda e: f"not {_is_null(f'{e}.v')}")
    return _map(found, lambda e: _group(_mapped(group), ONE, f"array({e})"))


def _each_dict(p: Payload, group: Sql, to_el: Callable[[Sql], Sql]) -> Sql:
    dicts = _only(p.visited(group), lambda e: _is_dict(f"{e}.v"))
    per_item = _map(dicts, lambda e: _group(_mapped(group), LIST, _map(p.named(e), to_el)))
    of_sub_dict = _group(_mapped(group), LIST, _map(f"{group}.els", to_el))
    return f"if({group}.form = {DICT}, array({of_sub_dict}), {per_item})"


def _keys(p: Payload, group: Sql) -> Sql:
    return _each_dict(p, group, lambda e: _text_el(_key_of(e)))


def _values(p: Payload, group: Sql) -> Sql:
    return _each_dict(p, group, lambda e: e)


def _cut(at: Sql, length: Sql) -> Sql:
    return f"slice({at}, 1, {length})"


def _recurse(p: Payload, group: Sql, name: str, up: int) -> Sql:
    test = (lambda key: f"rlike({key}, {_text(glob_to_regex(name))})") if "*" in name else (lambda key: f"{key} = {_text(name)}")
    starts = _only(f"{group}.els", lambda e: f"{e}.v is not null")

    def hits(start: Sql) -> Sql:
        own = f"{group}.form = {DICT} and coalesce({test(_key_of(start))}, false)"
        return _let(p.found(start, test), lambda inner: f"if({own}, concat(array({start}), {inner}), {inner})")

    def flat(start: Sql) -> Sql:
        return _flat_map(hits(start), lambda e: f"if({_is_list(f'{e}.v')}, {p.listed(f'{e}.v', f'{e}.at')}, array({e}))")

    def above(start: Sql) -> Sql:
        # not above where the search began: the list that holds the items, or the value itself
        is_item = f"{group}.form = {LIST} and size({start}.at) > 0 and {_key_of(start)} is null"
        top = f"size({start}.at) - if({is_item}, 1, 0)"
        return _map(hits(start), lambda e: p.at(_cut(f"{e}.at", f"greatest(size({e}.at) - {up}, {top})")))

    return _let(
        _flat_map(starts, above if up else flat), lambda found: _keep(f"size({found}) > 0", _group(f"{group}.mapped", LIST, found))
    )


def _keep(condition: Sql, group: Sql) -> Sql:
    return f"if(coalesce({condition}, false), array({group}), {_NONE})"


def _index(p: Payload, group: Sql, at: int) -> Sql:
    where = lambda els: str(at) if at >= 0 else f"size({els}) - {-at}"
    chosen = lambda el: _keep(f"{el} is not null", _group(f"{group}.mapped", ONE, f"array({el})"))
    return _let(p.members(group), lambda els: _let(f"get({els}, {where(els)})", chosen))


def _pick(p: Payload, group: Sql, *positions: int) -> Sql:
    def picked(els: Sql) -> Sql:
        found = _map(f"array({', '.join(map(str, positions))})", lambda n: f"get({els}, if({n} >= 0, {n}, size({els}) + {n}))")
        kept = _only(found, lambda el: f"{el} is not null")
        return _let(kept, lambda some: _keep(f"size({some}) > 0", _group(f"{group}.mapped", LIST, some)))

    return _let(p.members(group), picked)


def _slice(p: Payload, group: Sql, start: int | None, stop: int | None) -> Sql:
    def bound(value: int | None, default: Sql, size: Sql) -> Sql:
        if value is None:
            return default
        return f"least({value}, {size})" if value >= 0 else f"greatest({size} - {-value}, 0)"

    def cut(els: Sql) -> Sql:
        size = f"size({els})"
        low, high = bound(start, "0", size), bound(stop, size, size)
        part = f"slice({els}, {low} + 1, greatest({high} - {low}, 0))"
        return _keep(f"{els} is not null", _group(f"{group}.mapped", f"if({group}.form = {LIST}, {LIST}, {DICT})", part))

    return _let(p.members(group), cut)


def _where(group: Sql, keep_el: Callable[[Sql], Sql], keep_dict: Sql) -> Sql:
    kept = _only(f"{group}.els", lambda e: f"coalesce({keep_el(e)}, false)")
    some = _let(kept, lambda els: _keep(f"size({els}) > 0", _group(f"{group}.mapped", f"{group}.form", els)))
    return f"if({group}.form = {DICT}, {_keep(keep_dict, group)}, {some})"


def _el_text(el: Sql) -> Sql:
    return f"if({el}.v is null, {el}.txt, {_value_text(f'{el}.v')})"


def _where_value(p: Payload, group: Sql, pattern: str) -> Sql:
    return _where(group, lambda e: _test(_el_text(e), pattern), "false")


def _where_value_not(p: Payload, group: Sql, pattern: str) -> Sql:
    return _where(group, lambda e: f"not {_is_null(f'{e}.v')} and not {_test(_el_text(e), pattern)}", "true")


def _where_child(p: Payload, group: Sql, key: str, pattern: str, sign: str) -> Sql:
    fits = lambda value: _test(_value_text(value), pattern)
    if "*" in key:
        in_dict = lambda v: _any(f"map_entries(try_variant_get({v}, '$', 'map<string,variant>'))", lambda x: f"{_test(f'{x}.key', key)} and {fits(f'{x}.value')}")
        named = lambda e: _test(_key_of(e), key)
    else:
        in_dict = lambda v: _let(_child(v, key), fits)
        named = lambda e: f"{_key_of(e)} = {_text(key)}"
    held = _any(f"{group}.els", lambda e: f"coalesce({named(e)} and {fits(f'{e}.v')}, false)")
    return _where(group, lambda e: f"{_is_dict(f'{e}.v')} and {sign} coalesce({in_dict(f'{e}.v')}, false)", f"{sign} {held}")


def _up(p: Payload, group: Sql, levels: int) -> Sql:
    own = _only(f"{group}.els", lambda e: f"{e}.v is not null")

    def above(els: Sql) -> Sql:
        places = f"array_distinct({_map(els, lambda e: f'{e}.at')})"
        found = _map(places, lambda a: p.at(_cut(a, f"greatest(size({a}) - {levels}, 0)")))
        return _keep(f"size({els}) > 0 and {group}.form != {DICT}", _group(f"{group}.mapped", LIST, found))

    return _let(_let(own, p.ordered), above)


_STEPS: dict[str, Callable[..., Sql]] = {
    "key": _key, "keys": _keys, "values": _values, "recurse": _recurse, "index": _index, "pick": _pick, "slice": _slice,
    "where_value": _where_value, "where_value_not": _where_value_not, "where_child": _where_child, "up": _up,
}


# -- operators -----------------------------------------------------------------------------


def _straight(calls: tuple) -> int:
    """How many keys the path begins with that one look-up can follow."""
    n = 0
    while n < len(calls) and calls[n][0] == "key" and not set(calls[n][1][0]) & set("'?\\\"") and calls[n][1][0]:
        n += 1
    return n


def _last_key(dicts: Sql, names: list[str]) -> Sql:
    """The groups of a path of keys that leads to a list, ``dicts`` holding its items' values of the last key; null unless all
    items are dicts."""
    to_list = f"array({', '.join(f"named_struct('i', -1, 'k', {_text(n)})" for n in names[:-1])})"
    place = _below(_below(to_list, "i", "null"), -1, _text(names[-1]))
    value = f"x.`{names[-1]}`"
    groups = f"transform({dicts}, (x, i) -> {_group('true', ONE, f'array({_el(value, place)})')})"
    kept = _only(groups, lambda g: f"get({g}.els, 0).v is not null and not {_is_null(f'get({g}.els, 0).v')}")
    return f"if({_any(dicts, lambda x: f'{x} is null')}, null, {kept})"


def parsed(df: DataFrame, body: str) -> DataFrame:
    """Add what every path over ``body`` shares: the payload's VARIANT ``__v`` and its text ``__t``."""
    text = F.make_valid_utf8(F.col(body).cast("string"))
    outer = with_strict_json(df.withColumn("__t", text), "__t", "__v")
    # a payload that is one text holding JSON counts as that JSON
    quoted = F.ltrim("__t").startswith('"')
    inner = F.when(quoted, F.expr(f"if({_holds_json('__v')}, try_variant_get(__v, '$', 'string'), null)"))
    entered = with_strict_json(outer.withColumn("__in", inner), "__in", "__vin")
    whole = F.col("__vin").isNotNull()
    return entered.withColumns(
        {"__t": F.when(whole, F.col("__in")).otherwise(F.col("__t")), "__v": F.when(whole, F.col("__vin")).otherwise(F.col("__v"))}
    ).drop("__in", "__vin")


def resolve_json(df: DataFrame, expression: Path, out: str, with_json: bool = True) -> DataFrame:
    """Add the path's result over ``parsed`` payloads, as ``steps.resolve`` does over trees: ``struct<is_list, items:
    array<struct<kind, text, json>>>``, null where nothing matched or the payload is no JSON."""
    payload = Payload("__v", "__t", with_json, texts=any(name == "keys" for name, _ in expression.calls))
    state, calls = f"__state_{out}", expression.calls
    root = _group("false", ONE, f"array({_el('__v', _ROOT)})")
    first = f"if(__v is null, {_NONE}, array({root}))"
    straight = _straight(calls)
    if straight:  # keys that lead through dicts only are one look-up; the steps are for what it does not find
        names = [args[0] for _, args in calls[:straight]]
        at = f"array({', '.join(f"named_struct('i', -1, 'k', {_text(n)})" for n in names)})"
        found = f"""try_variant_get(__v, "${''.join(f"['{n}']" for n in names)}", 'variant')"""
        quick = _let(found, lambda v: f"if({v} is null or {_is_null(v)}, null, array({_group('false', ONE, f'array({_el(v, at)})')}))")
        if straight == len(calls) > 1 and "`" not in names[-1]:  # the last key of a list's dicts, if it holds nothing else
            of_items = f"""try_variant_get(__v, "${''.join(f"['{n}']" for n in names[:-1])}", 'array<struct<`{names[-1]}`:variant>>')"""
            df = df.withColumn(f"{state}_d", F.expr(of_items))
            quick = f"coalesce({quick}, {_last_key(f'{state}_d', names)})"
        df = df.withColumn(f"{state}_q", F.expr(quick))
        first = f"if({state}_q is not null, {_NONE}, {first})"
    df = df.withColumn(state, F.expr(first))
    for n, (name, args) in enumerate(calls):
        if straight and n == straight:
            df = df.withColumn(state, F.expr(f"coalesce({state}_q, {state})"))
        step = _STEPS[name]
        df = df.withColumn(state, F.expr(_flat_map(state, payload.settle)))
        df = df.withColumn(state, F.expr(_flat_map(state, lambda g: step(payload, g, *args))))
    if straight == len(calls) and straight:
        df = df.withColumn(state, F.expr(f"coalesce({state}_q, {state})"))
    closed = _map(state, lambda g: payload.closed(g, payload.texts))
    df = df.withColumn(state, F.expr(_only(closed, lambda p: f"{p} is not null")))
    mapped = _any(state, lambda p: f"{p}.mapped")
    is_list = f"{mapped} or {_any(state, lambda p: f'{p}.l')}"
    of_group = lambda g: _map(f"{g}.els", payload.item)
    if any(name == "slice" for name, _ in expression.calls):  # only then a group may be a part of a dict
        of_group = lambda g: f"if({g}.form = {DICT}, array({payload.sub_dict_item(f'{g}.els')}), {_map(f'{g}.els', payload.item)})"
    hit = f"size({state}) > 0 and (not {mapped} or {_any(state, lambda p: f'size({p}.els) > 0 or {p}.form = {DICT}')})"
    result = f"case when {hit} then named_struct('is_list', {is_list}, 'items', {_flat_map(state, of_group)}) end"
    return df.withColumn(out, F.expr(result)).drop(state, f"{state}_q", f"{state}_d")


def json_values(df: DataFrame, body: str, expression: Path, *ids: str) -> DataFrame:
    """One row per value of a path over JSON payloads."""
    source = parsed(df.select(*ids, F.col(body).alias("__body")), "__body").drop("__body")
    return explode_values(resolve_json(source, expression, "__values", with_json=False), "__values", *ids)


def _combined(df: DataFrame, expressions: tuple[Path, ...], out: str, every: bool) -> DataFrame:
    names = [f"__part{i}_{out}" for i in range(len(expressions))]
    for name, expression in zip(names, expressions, strict=True):
        df = resolve_json(df, expression, name)
    found = _only(f"array({', '.join(names)})", lambda r: f"{r} is not null")
    enough = f"size({found}) = {len(names)}" if every else "true"
    items = _flat_map(found, lambda r: f"{r}.items")
    combined = f"case when {enough} and size({items}) > 0 then named_struct('is_list', true, 'items', {items}) end"
    return df.withColumn(out, F.expr(combined)).drop(*names)


def json_any_of(df: DataFrame, *expressions: Path, out: str) -> DataFrame:
    """Over ``parsed`` payloads: the values of several paths, in path order; null when there are none."""
    return _combined(df, expressions, out, every=False)


def json_all_of(df: DataFrame, *expressions: Path, out: str) -> DataFrame:
    """Like ``json_any_of``, but null unless every path matched."""
    return _combined(df, expressions, out, every=True)


def json_record(df: DataFrame, schema: Mapping[str, Path], out: str) -> DataFrame:
    """Over ``parsed`` payloads: ``{name: value}`` as one JSON object without the unmatched names; null if none matched."""
    pairs, parts = [], []
    for i, (name, expression) in enumerate(schema.items()):
        part = f"__field{i}"
        df = resolve_json(df, expression, part)
        parts.append(part)
        pairs.append(F.concat(F.lit(json.dumps(name, ensure_ascii=False) + ": "), value_json(part)))
    df = df.withColumn("__pairs", F.array_compact(F.array(*pairs)))
    record = F.concat(F.lit("{"), F.array_join("__pairs", ", "), F.lit("}"))
    return df.withColumn(out, F.when(F.size("__pairs") > 0, record)).drop("__pairs", *parts)


def json_schema(df: DataFrame, body: str, schema: Mapping[str, Path], *ids: str, out: str = "record") -> DataFrame:
    """One JSON record per payload that matches at least one of the named paths."""
    records = json_record(parsed(df.select(*ids, F.col(body).alias("__body")), "__body").drop("__body"), schema, out)
    return explode_rows(records.withColumn("__found", F.array_compact(F.array(out))).drop(out), ids, F.col("__found"), out)


def json_items(df: DataFrame, body: str) -> DataFrame:
    """``parsed`` payloads, one row per item where the payload is a list, numbered by ``item`` (null otherwise)."""
    rows = parsed(spread_costly(df), body)
    items = F.expr("try_variant_get(__v, '$', 'array<variant>')")
    texts = F.expr("if(__list is null, null, from_json(__t, 'array<string>'))")
    pairs = F.expr("if(__list is null, array(named_struct('v', __v, 't', __t)), transform(__list, (x, i) -> named_struct('v', x, 't', get(__texts, i))))")
    kept = [c for c in rows.columns if c not in ("__v", "__t")]
    split = rows.withColumn("__list", items).withColumn("__texts", texts)
    out = split.select(*kept, F.col("__list").isNull().alias("__whole"), F.posexplode_outer(pairs).alias("__i", "__p"))
    # an empty list has no items, hence no rows
    out = out.filter("__whole or __i is not null")
    item: Column = F.when(~F.col("__whole"), F.col("__i"))
    return out.select(*kept, item.alias("item"), F.col("__p.v").alias("__v"), F.col("__p.t").alias("__t"))


def json_fields(df: DataFrame, body: str, schema: Mapping[str, Path], out: str = "filtered") -> DataFrame:
    """Keep the named paths of JSON payloads; see ``steps.filter_fields``."""
    rows = json_record(json_items(df, body), schema, out)
    kept = F.when(F.col("__v").isNull(), F.col(body).cast("string")).otherwise(F.coalesce(out, F.lit("{}")))
    return rows.withColumn(out, kept).drop("__v", "__t", body)
