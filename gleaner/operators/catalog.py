"""What a corpus contains: paths of its documents, and a schema over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import explode_rows

CATALOG_DEPTH = 4
LIST_HINTS = 3


def node_paths(
    df: DataFrame, *ids: str, tree: str = "tree", depth: int = CATALOG_DEPTH, positions: int = LIST_HINTS
) -> DataFrame:
    """One row per document and available path: keys of dicts, ``[keys]``, ``[values]``, the first ``positions`` of lists.

    All items of a list contribute their keys. The catalogue ends ``depth`` levels down: names come from
    as many ancestors in the same row, one pass per level, so nothing is joined.
    """
    most = depth
    # characters that make a key need parentheses in a path: a fixed value
    nodes = f"{tree}.nodes"
    name = lambda n: f"if(rlike({n}.key, '[.\\\\[\\\\](){{}}… ]'), concat('(', {n}.key, ')'), {n}.key)"
    # from the root down, one pass per level: a prefix is the parent's prefix plus the node's own key
    prefixed = df.select(
        *ids,
        F.col(nodes).alias("__n"),
        F.expr(f"transform({nodes}, n -> if(n.parent is null, '', null))").alias("__p"),
    )
    above = "get(__p, n.parent)"
    inherits = "get(__n, n.parent).kind = 'str' or n.kind = 'dict'"
    step = (
        f"case when {above} is null then null "
        f"when n.key is not null then if({above} = '', {name('n')}, concat({above}, '.', {name('n')})) "
        f"when {inherits} then {above} end"
    )
    for level in range(1, most + 1):
        prefixed = prefixed.withColumn(
            "__p", F.expr(f"transform(__n, (n, i) -> if(n.depth = {level}, {step}, get(__p, i)))")
        )
    own = "if(n.key is null, cast(array() as array<string>), array(get(__p, n.id)))"
    inside = (
        f"case when n.depth >= {most} then cast(array() as array<string>) "
        "when n.kind = 'dict' then array(concat(get(__p, n.id), '[keys]'), concat(get(__p, n.id), '[values]')) "
        f"when n.kind = 'list' and size(n.kids) > 0 then transform(sequence(0, least(size(n.kids), {positions}) - 1), "
        "i -> concat(get(__p, n.id), '[', i, ']')) else cast(array() as array<string>) end"
    )
    paths = F.expr(
        f"array_distinct(flatten(transform(filter(__n, n -> get(__p, n.id) is not null), n -> concat({own}, {inside}))))"
    )
    return explode_rows(prefixed, ids, paths, "path")


def corpus_schema(df: DataFrame, body: str) -> DataFrame:
    """One row: the schema that covers every JSON payload; a mergeable aggregate."""
    parsed = F.try_parse_json(F.col(body))
    return df.agg(F.schema_of_variant_agg(parsed).alias("schema"), F.count_if(parsed.isNotNull()).alias("documents"))
