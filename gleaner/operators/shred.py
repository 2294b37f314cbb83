"""Shredding: payload -> array of tree nodes, one distributed Arrow job.

A shredded row keeps its document's tree in one column, so that every later step is
a projection inside the row: no shuffle, no join, whatever the number of steps.
``explode_nodes`` gives the same tree as one row per node where rows are wanted.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from itertools import repeat
from json.encoder import encode_basestring
from math import isfinite
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import deepjson
from .parsers import FORMATS, parse_payload
from .reach import Reach, prune
from .rows import spread_costly

NODES_PER_BATCH = 100_000

NODE_TYPE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),  # preorder position in the document
        T.StructField("parent", T.IntegerType()),  # null at the root
        T.StructField("last", T.IntegerType()),  # last preorder id inside the subtree
        T.StructField("depth", T.IntegerType()),
        T.StructField("key", T.StringType()),  # null for list items and the root
        T.StructField("pos", T.IntegerType()),  # ordinal among the siblings
        T.StructField("kind", T.StringType()),  # dict list str int float bool null
        T.StructField("sval", T.StringType()),  # text of scalars and of lists of scalars
        T.StructField("embedded", T.BooleanType()),  # inside JSON text held by a string
        T.StructField("level", T.IntegerType()),  # dict nesting; null where flattening stops
        T.StructField("at", T.IntegerType()),  # byte position of the node in ``json``
        T.StructField("size", T.IntegerType()),  # byte length of the node in ``json``
        T.StructField("kids", T.ArrayType(T.IntegerType())),
        T.StructField("path", T.StringType()),  # dotted path from the root, on request only
    ]
)
TREE_TYPE = T.StructType(
    [
        T.StructField("format", T.StringType()),
        T.StructField("json", T.BinaryType()),
        T.StructField("nodes", T.ArrayType(NODE_TYPE)),
    ]
)

_KIND_NAMES = ("dict", "list", "str", "int", "float", "bool", "null")
_DICT, _LIST, _STR, _INT, _FLOAT, _BOOL, _NULL = range(7)
_CODES = {dict: _DICT, list: _LIST, str: _STR, int: _INT, float: _FLOAT, bool: _BOOL, type(None): _NULL}
_NO_LEVEL = -(2**31)


def _clean(texts: list) -> list:
    """Texts without lone surrogates, which no UTF-8 column can hold."""
    return [t if t is None else t.encode("utf-8", "replace").decode() for t in texts]


def _strings(texts: list) -> pa.Array:
    try:
        return pa.array(texts, pa.string())
    except UnicodeEncodeError:
        return pa.array(_clean(texts), pa.string())


def _byte_lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _json_lengths(texts: pa.Array) -> np.ndarray:
    """Byte lengths of texts in JSON form; repeated texts are measured once."""
    coded = texts.dictionary_encode()
    distinct = pa.array([encode_basestring(t) for t in coded.dictionary.to_pylist()], pa.string())
    return _byte_lengths(distinct)[coded.indices.to_numpy(zero_copy_only=False)]


class _Nodes:
    """Nodes of the documents of one output batch, in preorder.

    The walk over a tree records five facts per node; everything else follows from them for the
    whole batch at once, in numpy.
    """

    def __init__(self, paths: bool, embedded: bool = True) -> None:
        self.paths = paths
        self.embedded = embedded  # whether JSON inside strings gets nodes
        self.parents: list[int] = []  # position in the batch, -1 at a document's root
        self.depths: list[int] = []
        self.keys: list[str | None] = []
        self.texts: list[str | None] = []
        self.codes: list[int] = []
        self.json_sizes: dict[int, int] = {}  # nodes whose JSON length is not that of their text
        self.counts: list[int] = []

    def __len__(self) -> int:
        return len(self.parents)

    def add(self, tree: Any) -> bytes:
        """Append one document's nodes; returns its JSON text, to which ``at`` points: the
        document's own text, then those of the JSON that its strings hold."""
        parents, depths, keys, texts, codes = self.parents, self.depths, self.keys, self.texts, self.codes
        base, embedded = len(parents), self.embedded
        documents: list[str] = [deepjson.dumps(tree)]
        # containers being walked: what is left of them, their position and their children's depth
        open_: list[tuple[Iterator, int, int]] = [(iter(((None, tree),)), -1, 0)]
        while open_:
            items, parent, depth = open_[-1]
            for key, value in items:
                kind = type(value)
                node = len(parents)
                parents.append(parent)
                depths.append(depth)
                keys.append(key)
                codes.append(_CODES[kind])
                if kind is str:
                    texts.append(value)
                    if embedded and value.startswith(("{", "[")):
                        try:
                            inner = deepjson.loads(value)
                        except ValueError:
                            continue
                        documents.append(deepjson.dumps(inner))
                        open_.append((iter(((None, inner),)), node, depth + 1))
                        break
                elif kind is dict or kind is list:
                    flat = kind is list and not any(type(item) is dict or type(item) is list for item in value)
                    texts.append((str(value) if value else "") if flat else None)
                    if kind is dict:
                        names = ["null" if name is None else name for name in value] if None in value else value
                        open_.append((zip(names, value.values()), node, depth + 1))
                    else:
                        open_.append((zip(repeat(None), value), node, depth + 1))
                    break
                elif value is None:
                    texts.append("")
                else:
                    texts.append(str(value))
                    if kind is float and not isfinite(value):
                        self.json_sizes[node] = len(json.dumps(value))
            else:
                open_.pop()
        self.counts.append(len(parents) - base)
        return "".join(documents).encode("utf-8", "replace")

    def array(self) -> pa.Array:
        counts = np.asarray(self.counts, dtype=np.int64)
        total = len(self)
        first = np.repeat(np.cumsum(counts) - counts, counts)  # the batch position of each node's document
        here = np.arange(total, dtype=np.int64)
        parent = np.asarray(self.parents, dtype=np.int64)
        depth = np.asarray(self.depths, dtype=np.int64)
        code = np.asarray(self.codes, dtype=np.int8)
        is_root = parent < 0
        above = np.where(is_root, here, parent)
        # short numbers are sorted faster
        by_depth = np.argsort(depth.astype(np.int16) if depth.max(initial=0) < 2**15 else depth, kind="stable")
        cuts = np.searchsorted(depth[by_depth], np.arange(depth.max(initial=0) + 2))
        levels = [by_depth[cuts[d] : cuts[d + 1]] for d in range(1, len(cuts) - 1)]  # without the roots

        # children in order, and a node's position among them
        inner = np.flatnonzero(~is_root)
        order = np.argsort(parent[inner], kind="stable")
        kid_counts = np.bincount(parent[inner], minlength=total)
        offsets = np.concatenate([[0], np.cumsum(kid_counts)])
        kids = pa.ListArray.from_arrays(
            pa.array(offsets.astype(np.int32)), pa.array((here - first)[inner][order].astype(np.int32))
        )
        pos = np.zeros(total, dtype=np.int64)
        pos[inner[order]] = np.arange(len(inner)) - offsets[parent[inner][order]]

        # downwards: what a node inherits. upwards: how many nodes lie below it
        starts_text = is_root | (code[above] == _STR)  # a document, or the JSON inside a string
        embedded = np.zeros(total, dtype=bool)
        level = np.where(code == _DICT, 0, -1)
        text_of = here.copy()
        for nodes in levels:
            up = parent[nodes]
            embedded[nodes] = embedded[up] | (code[up] == _STR)
            closed = (code[up] == _LIST) & (code[above[up]] == _LIST) & (above[up] != up)
            none = embedded[nodes] | closed | (level[up] == _NO_LEVEL)
            level[nodes] = np.where(none, _NO_LEVEL, level[up] + (code[nodes] == _DICT))
            text_of[nodes] = np.where(starts_text[nodes], nodes, text_of[up])
        below = np.ones(total, dtype=np.int64)
        below_in_text = np.ones(total, dtype=np.int64)
        for nodes in reversed(levels):
            np.add.at(below, parent[nodes], below[nodes])
            same = nodes[~starts_text[nodes]]
            np.add.at(below_in_text, parent[same], below_in_text[same])

        keys, texts = _strings(self.keys), _strings(self.texts)
        at, size = self._text_positions(keys, texts, counts, code, pos, above, starts_text, text_of, below_in_text)

        def ints(values: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
            return pa.array(values.astype(np.int32), pa.int32(), mask=null)

        kinds = pa.DictionaryArray.from_arrays(pa.array(code), pa.array(_KIND_NAMES)).cast(pa.string())
        columns = {
            "id": ints(here - first),
            "parent": ints(above - first, is_root),
            "last": ints(here - first + below - 1),
            "depth": ints(depth),
            "key": keys,
            "pos": ints(pos),
            "kind": kinds,
            "sval": texts,
            "embedded": pa.array(embedded),
            "level": ints(level, level == _NO_LEVEL),
            "at": ints(at),
            "size": ints(size),
            "kids": kids,
            "path": _strings(self._paths(pos)) if self.paths else pa.nulls(total, pa.string()),
        }
        structs = pa.StructArray.from_arrays([columns[f.name] for f in NODE_TYPE.fields], names=NODE_TYPE.fieldNames())
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), structs)

    def _text_positions(self, keys, texts, counts, code, pos, above, starts_text, text_of, below_in_text):
        """Byte position and length of every node in its document's JSON text.

        The text is a sequence of tokens: per node its separator and key, then a scalar's text or an
        opening bracket; closing brackets follow the last node of their container.
        """
        total = len(code)
        if total == 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        own = _byte_lengths(texts)
        quoted = np.flatnonzero(code == _STR)
        own[quoted] = _json_lengths(texts.take(pa.array(quoted)))
        own[code == _NULL] = 4
        opens = (code == _DICT) | (code == _LIST)
        own[opens] = 1
        for node, length in self.json_sizes.items():
            own[node], opens[node] = length, False
        in_dict = (code[above] == _DICT) & ~starts_text
        lead = np.where((pos > 0) & ~starts_text, 2, 0)
        named = np.flatnonzero(in_dict)
        lead[named] += _json_lengths(keys.take(pa.array(named))) + 2

        # the texts one after the other, each one's nodes together
        order = np.argsort(text_of, kind="stable")
        place = np.empty(total, dtype=np.int64)
        place[order] = np.arange(total)
        boxes = np.flatnonzero(opens)
        ends = place[boxes] + below_in_text[boxes] - 1
        closing = np.bincount(ends, minlength=total)
        tokens = (lead + own)[order]
        written = np.cumsum(tokens + closing)
        before = written - tokens - closing
        start = before[place] + lead
        size = own.copy()
        # of the brackets closed at one place, the innermost comes first
        ranking = np.lexsort((-place[boxes], ends))
        closed_here = np.empty(len(boxes), dtype=np.int64)
        group_start = np.searchsorted(ends[ranking], ends[ranking], side="left")
        closed_here[ranking] = np.arange(len(boxes)) - group_start + 1
        size[boxes] = written[ends] - closing[ends] + closed_here - start[boxes]
        doc_first = np.cumsum(counts) - counts
        bases = np.zeros(len(counts), dtype=np.int64)
        filled = counts > 0
        bases[filled] = before[doc_first[filled]]
        return start - np.repeat(bases, counts), size

    def _paths(self, pos: np.ndarray) -> list[str]:
        paths: list[str] = []
        for parent, key, at in zip(self.parents, self.keys, pos.tolist()):
            if parent < 0:
                paths.append("")
                continue
            name = key if key is not None else str(at)
            paths.append(f"{paths[parent]}.{name}" if paths[parent] else name)
        return paths


def _tree_array(formats: list, texts: list, nodes: _Nodes) -> pa.Array:
    return pa.StructArray.from_arrays(
        [pa.array(formats, pa.string()), pa.array(texts, pa.binary()), nodes.array()],
        names=TREE_TYPE.fieldNames(),
    )


def shred(
    df: DataFrame,
    body: str,
    format: str | None = None,
    keep: Iterable[str] | None = None,
    split_lists: bool = False,
    paths: bool = False,
    reach: Reach | None = None,
    embedded: bool = True,
) -> DataFrame:
    """Parse the payload column and add its tree as column ``tree``.

    ``format`` names the format, null detects it per payload. ``keep`` lists the columns to carry
    along (all but the payload by default): narrow it, every carried column passes
    through Arrow. A blank or unparsable payload keeps its row with a null format and no nodes.

    ``split_lists`` turns a payload that is a list (JSON array, NDJSON, CSV) into one row per
    item, numbered in column ``item`` (null otherwise), so that a payload with very many items
    never has to fit into one row. ``paths`` fills the nodes' dotted paths, which only
    flattening needs. ``reach`` limits the tree to what some paths need, see ``shred_for``. Without
    ``embedded`` a string that holds JSON is a string only, which is all that flattening looks at.
    """
    if format is not None and format not in FORMATS:
        raise ValueError(f"unknown format {format!r}, expected one of {', '.join(FORMATS)}")
    carried = [c for c in df.columns if c != body] if keep is None else list(keep)
    source = spread_costly(df).select(*carried, F.col(body).cast("binary").alias("__body"))
    added = [T.StructField("item", T.IntegerType())] if split_lists else []
    schema = T.StructType([source.schema[c] for c in carried] + added + [T.StructField("tree", TREE_TYPE)])

    def rows(bodies: pa.Array) -> Iterator[tuple[int, int | None, str | None, Any]]:
        for at in range(len(bodies)):
            name, tree = parse_payload(bodies[at].as_py(), format)
            if split_lists and name is not None and isinstance(tree, list):
                for number, item in enumerate(tree):
                    yield at, number, name, item if reach is None else prune(item, reach)
            else:
                yield at, None, name, tree if reach is None or name is None else prune(tree, reach)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000_000))  # pruning follows a document to its depth
        for batch in batches:
            sources, items, formats, texts, nodes = [], [], [], [], _Nodes(paths, embedded)

            def flush() -> pa.RecordBatch:
                chosen = pa.array(sources, pa.int64())
                columns = [batch.column(i).take(chosen) for i in range(len(carried))]
                columns += [pa.array(items, pa.int32())] if split_lists else []
                return pa.RecordBatch.from_arrays(
                    columns + [_tree_array(formats, texts, nodes)], names=schema.fieldNames()
                )

            for at, number, name, tree in rows(batch.column(len(carried))):
                sources.append(at)
                items.append(number)
                formats.append(name)
                if name is None:
                    nodes.counts.append(0)
                    texts.append(None)
                else:
                    texts.append(nodes.add(tree))
                if len(nodes) >= NODES_PER_BATCH:
                    yield flush()
                    sources, items, formats, texts, nodes = [], [], [], [], _Nodes(paths, embedded)
            if sources:
                yield flush()

    return source.mapInArrow(run, schema)


def detect_format(df: DataFrame, body: str, keep: Iterable[str] | None = None) -> DataFrame:
    """Add the detected format as column ``format``, without building any nodes."""
    carried = [c for c in df.columns if c != body] if keep is None else list(keep)
    source = spread_costly(df).select(*carried, F.col(body).cast("binary").alias("__body"))
    schema = T.StructType([source.schema[c] for c in carried] + [T.StructField("format", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse_payload(b.as_py())[0] for b in batch.column(len(carried))]
            columns = [batch.column(i) for i in range(len(carried))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(found, pa.string())], names=carried + ["format"])

    return source.mapInArrow(run, schema)


def explode_nodes(shredded: DataFrame, *ids: str) -> DataFrame:
    """One row per node: the given columns, then the node's fields."""
    return shredded.select(*ids, F.explode("tree.nodes").alias("n")).select(*ids, "n.*")


def node_json(tree: str, node) -> F.Column:
    """JSON text of a node, cut out of the document's text."""
    return F.substring(F.col(f"{tree}.json"), node["at"] + 1, node["size"]).cast("string")
