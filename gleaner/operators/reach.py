"""Which parts of a document a set of paths can reach: column pruning for trees.

The shredder drops the other parts right after parsing, before any node is made of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from typing import Any

from . import deepjson


@dataclass
class Reach:
    """What is needed of a value (of every item, if it is a list)."""

    all: bool = False  # the value as it is
    whole_dict: bool = False  # keys count by position: a dict stays as it is
    keys: dict[str, Reach] = field(default_factory=dict)
    find: set[str] = field(default_factory=set)  # keys (or globs) wanted at any depth
    items: Reach | None = None  # what a selected item needs
    above: Reach | None = None  # what a container needs that is found from a hit inside it

    def add(self, ops: Sequence[tuple[str, Any]]) -> None:
        """Widen by a path, given as (step, argument) pairs."""
        if not ops:
            self.all = True
            return
        (op, arg), rest = ops[0], ops[1:]
        if op == "key":
            self.keys.setdefault(arg, Reach()).add(rest)
        elif op == "select":
            self.whole_dict = True
            self.items = self.items or Reach()
            self.items.add(rest)
        elif op == "where_child" and "*" not in arg:
            self.keys.setdefault(arg, Reach()).all = True
            self.add(rest)
        elif op == "where_value":
            self.add(rest)
        elif op == "recurse":
            self.find.add(arg)
        else:  # names, values, ancestors: everything may show up
            self.all = True

    def needs_all(self) -> bool:
        # mapping and selection over one list, or search beside keys, are not worth telling apart
        return self.all or (self.items is not None and bool(self.keys)) or bool(self.find and (self.keys or self.items))


def reach_of(paths: Sequence[Sequence[tuple[str, Any]]]) -> Reach | None:
    """Common reach of several paths; ``None`` for the whole document."""
    reach = Reach()
    for ops in paths:
        if any(op == "up" for op, _ in ops):
            return _reach_above(ops) if len(paths) == 1 else None  # ancestors may be the root
        reach.add(ops)
    return None if reach.needs_all() else reach


def _reach_above(ops: Sequence[tuple[str, Any]]) -> Reach | None:
    """Reach of a search from the root for containers around its hits, of which some keys are wanted."""
    (op, name), rest = ops[0], ops[1:]
    if op != "up" or not isinstance(name, str) or not rest or any(step != "key" for step, _ in rest):
        return None
    above = Reach()
    above.add(rest)
    return Reach(find={name}, above=above)


def prune(value: Any, reach: Reach) -> Any:
    """The reachable part of a value. Text stays, also when it holds JSON."""
    if reach.needs_all():
        return value
    if reach.find:
        return _search(value, reach.find, reach.above)
    if isinstance(value, list):
        return [prune(item, reach.items or reach) for item in value]
    if isinstance(value, dict) and not reach.whole_dict:
        return {key: prune(value[key], inner) for key, inner in reach.keys.items() if key in value}
    return value


def _search(value: Any, wanted: set[str], above: Reach | None = None) -> Any:
    """The hits and the containers around them; with ``above`` these keep what it names, and lists all of their items."""
    exact = {name for name in wanted if "*" not in name}
    globs = [name for name in wanted if "*" in name]
    named = above.keys if above is not None else {}

    def hit(key: Any) -> bool:
        return key in exact or (bool(globs) and isinstance(key, str) and any(fnmatchcase(key, g) for g in globs))

    def kept(part: Any) -> Any:
        """The part with its hits, ``None`` where it has none."""
        if isinstance(part, dict):
            found, hits = {}, False
            for key, inner in part.items():
                if hit(key):
                    found[key], hits = inner, True
                elif isinstance(inner, (dict, list, str)) and (below := kept(inner)) is not None:
                    found[key], hits = inner if key in named else below, True
                elif key in named:
                    found[key] = prune(inner, named[key])
            return found if hits else None
        if isinstance(part, list):
            if above is None:
                return [below for item in part if (below := kept(item)) is not None] or None
            items = [kept(item) for item in part]
            if all(below is None for below in items):
                return None
            return [prune(item, above) if below is None else below for item, below in zip(part, items)]
        if isinstance(part, str) and part.startswith(("{", "[")):
            if not globs and "\\" not in part and not any(name in part for name in exact):
                return None  # a key without escapes stands in the text as it is
            try:
                inner = deepjson.loads(part)
            except ValueError:
                return None
            return part if kept(inner) is not None else None
        return None

    found = kept(value)
    if found is None:
        return {} if isinstance(value, dict) else [] if isinstance(value, list) else value
    return found
