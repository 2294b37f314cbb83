"""Row shaping: records out of documents, flattening, wide tables, envelopes, sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import strict_json
from ..functions.text import decode_lossy, split_lines
from ..session import cut_lineage
from .rows import explode_rows, spread_small
from .shred import shred
from .steps import Path, value_json, value_text
from .variant_paths import parsed, resolve_json

# Keys whose list is the main list of a document however many scalars surround it.
MAIN_LIST_KEYS = ("results", "products", "organic_results", "items")
MAX_SCALARS_BESIDE_LIST = 8
DEFAULT_DEPTH = 5
MAX_COLUMNS = 10_000


def quote_json(text: Column) -> Column:
    """A text as JSON."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


# -- merging payloads ------------------------------------------------------------------


def with_source_url(payloads: DataFrame, manifest: DataFrame, file: str = "file") -> DataFrame:
    """Add ``url``, the input that produced the file, null where the manifest does not know it."""
    names = manifest.groupBy(F.col("file").alias(file)).agg(F.max("input").alias("url"))
    return payloads.join(names, file, "left")


def merge_records(payloads: DataFrame, body: str, url: str, *keep: str) -> DataFrame:
    """One JSON object per payload: objects as they are plus ``_url``, other JSON as ``data``, the
    rest as ``content``."""
    source = payloads.select(*keep, url, F.col(body).alias("__content"), F.col(body).alias("__payload"))
    trees = shred(source, "__payload", "json")
    root = "get(tree.nodes, 0)"
    text = F.expr(f"cast(substring(tree.json, 1, {root}.size) as string)")
    has_url = F.coalesce(F.col(url) != "", F.lit(False))
    link = F.concat(F.lit('"_url": '), quote_json(F.col(url)))
    own_url = F.expr(f"exists({root}.kids, k -> get(tree.nodes, k).key = '_url')")
    opened = F.expr("left(__text, length(__text) - 1)")
    content = F.concat(F.lit('{"content": '), quote_json(decode_lossy(F.col("__content"))))
    return (
        trees.withColumn("__text", text)
        .withColumn(
            "record",
            F.when(
                F.col("tree.format").isNull(),
                F.concat(content, F.when(has_url, F.concat(F.lit(", "), link)).otherwise(F.lit("")), F.lit("}")),
            )
            .when(~has_url, F.col("__text"))
            .when(
                F.expr(f"{root}.kind") != "dict",
                F.concat(F.lit("{"), link, F.lit(', "data": '), F.col("__text"), F.lit("}")),
            )
            .when(own_url, F.col("__text"))
            .otherwise(
                F.concat(opened, F.when(F.col("__text") == "{}", F.lit("")).otherwise(F.lit(", ")), link, F.lit("}"))
            ),
        )
        .select(*keep, "record")
    )


def merge_text(payloads: DataFrame, body: str, url: str, *keep: str) -> DataFrame:
    """Payload texts under a ``# url`` line, each followed by a blank line."""
    title = F.when(F.col(url) != "", F.array(F.concat(F.lit("# "), F.col(url)))).otherwise(
        F.array().cast("array<string>")
    )
    lines = F.concat(F.coalesce(title, F.array().cast("array<string>")), split_lines(decode_lossy(F.col(body))))
    return payloads.select(*keep, F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("text"))


# -- records ---------------------------------------------------------------------------


def main_list(tree: str = "tree") -> Column:
    """Node id of the list that makes an object a collection, null for a single-item object.

    Going through the keys in order, a list with objects replaces the best one so far if it is
    longer than that one's number of objects.
    """
    nodes = f"{tree}.nodes"
    objects = f"size(filter(get({nodes}, k).kids, i -> get({nodes}, i).kind = 'dict'))"
    better = f"get({nodes}, k).kind = 'list' and size(get({nodes}, k).kids) > best.n and {objects} > 0"
    best = (
        f"aggregate(get({nodes}, 0).kids, cast(struct(null, 0) as struct<id:int,n:int>), "
        f"(best, k) -> if({better}, cast(struct(k, {objects}) as struct<id:int,n:int>), best)).id"
    )
    scalars = f"size(filter(get({nodes}, 0).kids, k -> get({nodes}, k).kind not in ('dict', 'list')))"
    named = ", ".join(f"'{k}'" for k in MAIN_LIST_KEYS)
    return F.expr(
        f"get(transform(array({best}), b -> if({scalars} > {MAX_SCALARS_BESIDE_LIST} "
        f"and get({nodes}, b).key not in ({named}), null, b)), 0)"
    )


def record_ids(df: DataFrame, out: str = "records", tree: str = "tree") -> DataFrame:
    """Node ids of the document's records: the objects of a list, of the main list, or the
    object itself; none for a scalar document."""
    objects = f"filter(get({tree}.nodes, {{}}).kids, i -> get({tree}.nodes, i).kind = 'dict')"
    with_main = df.withColumn("__main", F.when(F.expr(f"get({tree}.nodes, 0).kind = 'dict'"), main_list(tree)))
    return with_main.withColumn(
        out,
        F.expr(
            f"case get({tree}.nodes, 0).kind when 'list' then {objects.format(0)} "
            f"when 'dict' then if(__main is null, array(0), {objects.format('__main')}) "
            f"else cast(array() as array<int>) end"
        ),
    ).drop("__main")


def explode_records(df: DataFrame, *ids: str, tree: str = "tree") -> DataFrame:
    """One row per record: the given columns, its ordinal ``rec`` and its JSON text ``record``."""
    cut = F.expr(
        f"transform(records, r -> cast(substring({tree}.json, get({tree}.nodes, r).at + 1, "
        f"get({tree}.nodes, r).size) as string))"
    )
    return explode_rows(record_ids(df, tree=tree), ids, cut, "record", "rec")


_ENTRY = "struct<key:string,value:string>"


def cells_from(entries: str) -> str:
    """Entries as a map; of entries with the same key the last one's value counts."""
    unique = f"size(array_distinct({entries}.key)) = size({entries})"
    last_wins = (
        f"transform(array_distinct({entries}.key), k -> "
        f"cast(struct(k, element_at(filter({entries}, e -> e.key = k), -1).value) as {_ENTRY}))"
    )
    return f"map_from_entries(if({unique}, {entries}, {last_wins}))"


def flat_entries(record: str, max_depth: int, tree: str) -> str:
    """Leaves of one record as (dotted key, text), in document order."""
    nodes = f"{tree}.nodes"
    json_text = f"cast(substring({tree}.json, n.at + 1, n.size) as string)"

    def leaf(n: str, p: str, r: str) -> str:
        rel = f"({n}.level - {r}.level)"
        in_dict, in_list = f"{p}.kind = 'dict'", f"{p}.kind = 'list'"
        open_list = f"{in_list} and {p}.sval is null and {rel} < {max_depth}"
        return (
            f"case {n}.kind when 'dict' then {in_dict} and {rel} = {max_depth} + 1 "
            f"when 'list' then ({in_dict} and if({n}.sval is not null, {rel} <= {max_depth}, {rel} = {max_depth})) "
            f"or ({open_list}) "
            f"else ({in_dict} and {rel} <= {max_depth}) or ({open_list}) end"
        )

    def value() -> str:
        as_json = f"n.kind = 'dict' or (n.kind = 'list' and (n.sval is null or get({nodes}, n.parent).kind = 'list'))"
        return f"if({as_json}, {json_text}, n.sval)"

    r = f"get({nodes}, {record})"
    below = f"slice({nodes}, {record} + 2, {r}.last - {record})"
    test = leaf("n", f"get({nodes}, n.parent)", r)
    key = f"if({r}.path = '', n.path, substring(n.path, length({r}.path) + 2))"
    return f"transform(filter({below}, n -> not n.embedded and coalesce({test}, false)), n -> cast(struct({key}, {value()}) as {_ENTRY}))"


def _top_entries(record: str, tree: str) -> str:
    nodes = f"{tree}.nodes"
    value = f"if(n.kind in ('dict', 'list'), cast(substring({tree}.json, n.at + 1, n.size) as string), n.sval)"
    kid = f"get(transform(array(get({nodes}, k)), n -> cast(struct(n.key, {value}) as {_ENTRY})), 0)"
    return f"transform(get({nodes}, {record}).kids, k -> {kid})"


def nesting_depth(record: str, tree: str = "tree") -> str:
    """SQL: how many dict levels a record nests (lists add none)."""
    nodes = f"{tree}.nodes"
    r = f"get({nodes}, {record})"
    levels = f"transform(filter(slice({nodes}, {record} + 1, {r}.last - {record} + 1), n -> n.kind = 'dict' and not n.embedded), n -> n.level)"
    return f"array_max({levels}) - {r}.level"


def max_nesting_depth(df: DataFrame, *ids: str, tree: str = "tree") -> DataFrame:
    """Nesting depth per record: the given columns, ``rec``, ``depth``."""
    depths = F.expr(f"transform(records, r -> {nesting_depth('r', tree)})")
    return explode_rows(record_ids(df, tree=tree), ids, depths, "depth", "rec")


def flatten_records(
    df: DataFrame, *ids: str, max_depth: int | None = None, url: str | None = None, tree: str = "tree"
) -> DataFrame:
    """One row per record with its dotted cells: the given columns, ``rec``, ``cells`` (a map).

    Without ``max_depth`` a record that nests deeper than the default fails the job.
    The documents must be shredded with ``paths=True``.
    """
    depth = DEFAULT_DEPTH if max_depth is None else max_depth
    entries = flat_entries("r", depth, tree)
    if max_depth is None:
        message = f"concat('nesting depth ', {nesting_depth('r', tree)}, ' exceeds the default of {DEFAULT_DEPTH}: name a depth')"
        entries = f"if({nesting_depth('r', tree)} > {DEFAULT_DEPTH}, cast(raise_error({message}) as array<{_ENTRY}>), {entries})"
    return _cells(record_ids(df, tree=tree), entries, ids, url)


def stringify_records(df: DataFrame, *ids: str, url: str | None = None, tree: str = "tree") -> DataFrame:
    """Like ``flatten_records`` for the top level only: containers as JSON text, null as ``''``."""
    return _cells(record_ids(df, tree=tree), _top_entries("r", tree), ids, url)


def _cells(df: DataFrame, entries: str, ids: Sequence[str], url: str | None) -> DataFrame:
    if url is not None:
        head = f"if(coalesce({url}, '') = '', cast(array() as array<{_ENTRY}>), array(cast(struct('_url', {url}) as {_ENTRY})))"
        entries = f"concat({head}, {entries})"
    flat = explode_rows(df, ids, F.expr(f"transform(records, r -> {entries})"), "__entries", "rec")
    return flat.select(*ids, "rec", F.expr(cells_from("__entries")).alias("cells"))


def explode_cells(df: DataFrame, *ids: str, cells: str = "cells") -> DataFrame:
    """Long form: one row per cell."""
    return explode_rows(df, ids, F.map_entries(cells), "__cell", "pos").select(
        *ids, "pos", F.col("__cell.key").alias("key"), F.col("__cell.value").alias("value")
    )


def dedupe_rows(df: DataFrame, order: Sequence[str], cells: str = "cells") -> DataFrame:
    """First of the rows with the same cells, whatever their order; adds ``copies``.

    Rows travel once per task and distinct content: the minimum is taken before the shuffle.
    """
    content = F.sha2(F.to_json(F.array_sort(F.map_entries(cells))), 256)
    return (
        df.groupBy(content.alias("__content"))
        .agg(
            F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row"),
            F.count("*").alias("copies"),
        )
        .select("__row.*", "copies")
    )


def select_columns(df: DataFrame, names: Sequence[str], *ids: str, cells: str = "cells") -> DataFrame:
    """Wide table of the named cells (and ``_url`` if any row has one); rows without a value in
    any of them go. Unknown names only, or no row left, is an error."""
    df = cut_lineage(df)  # looked at twice, parsed once
    wanted = [n for n in dict.fromkeys(names) if n != "_url"]
    filled = F.lit(False)
    for name in names:
        filled = filled | (F.coalesce(F.try_element_at(cells, F.lit(name)), F.lit("")) != "")
    known = F.arrays_overlap(F.map_keys(cells), F.array(*[F.lit(n) for n in wanted]))
    facts = df.agg(
        F.bool_or(known).alias("known"),
        F.bool_or(filled).alias("any"),
        F.bool_or(filled & F.map_contains_key(cells, "_url")).alias("url"),
    ).first()
    if not facts["known"]:
        available = ", ".join(column_names(df, ids, cells)) or "(none)"
        raise ValueError(f"none of the columns exist: {', '.join(names)}; available: {available}")
    if not facts["any"]:
        raise ValueError("no row has a value in the selected columns")
    columns = (["_url"] if facts["url"] else []) + wanted
    return df.filter(filled).select(*ids, *_cell_columns(columns, cells))


def _cell_columns(names: Sequence[str], cells: str) -> list[Column]:
    return [F.coalesce(F.try_element_at(cells, F.lit(n)), F.lit("")).alias(n) for n in names]


def _first_seen(df: DataFrame, order: Sequence[str], cells: str) -> DataFrame:
    """``__key, __first``: every cell name with the place it is first seen at."""
    seen = explode_rows(df, order, F.map_keys(cells), "__key", "__at")
    return seen.groupBy("__key").agg(F.min(F.struct(*order, "__at")).alias("__first"))


def column_names(df: DataFrame, order: Sequence[str] = (), cells: str = "cells") -> list[str]:
    """Cell names in first-seen order. Names are schema, not data: more than ``MAX_COLUMNS``
    is an error, so what reaches the driver is bounded."""
    names = (
        _first_seen(df, order, cells)
        .orderBy("__first", "__key")
        .select("__key")
        .limit(MAX_COLUMNS + 1)
        .collect()
    )
    if len(names) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} distinct columns, see write_wide_csv")
    return [row[0] for row in names]


def union_columns(
    df: DataFrame, order: Sequence[str], *ids: str, cells: str = "cells", columns: Sequence[str] | None = None
) -> DataFrame:
    """Wide table over the union of all cell names, in first-seen order; missing cells are ``''``.

    The names are found in one aggregation over the cells, which are kept for that, so that payloads are parsed once; ``columns``
    gives them beforehand and saves that pass. The table itself is a projection of the map, without a pivot's shuffle.
    """
    df = cut_lineage(df) if columns is None else df
    names = column_names(df, order, cells) if columns is None else columns
    return df.select(*ids, *_cell_columns(names, cells))


# -- sinks -----------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str, order: Sequence[str] = (), mode: str = "error") -> None:
    """Table as CSV with a header, quotes doubled; sorted across and within the files if asked."""
    drop = [c for c in order if c.startswith("__")]
    sorted_df = df.orderBy(*order).drop(*drop) if order else df
    sorted_df.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def _csv_cell(value: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.rlike('[,"\\r\\n]'), quoted).otherwise(value)


def wide_lines(df: DataFrame, order: Sequence[str], cells: str = "cells") -> DataFrame:
    """``union_columns`` as CSV lines, for any number of names: ``part`` (0 for the header), the columns of ``order`` and ``line``, sorted.

    No name becomes a column and none reaches the driver. The cells are joined with their names' places, and what lies between
    the cells of a row is one run of commas, so that a row costs its cells and its line, not a look-up per name. Rows are
    sorted before they are made wide. No row gives no line, rows without cells give an empty header and empty lines.
    """
    quoted = F.transform_values(cells, lambda _, value: _csv_cell(value))
    df = cut_lineage(df.select(*order, quoted.alias("__cells")).withColumn("__row", F.monotonically_increasing_id()))  # looked at twice, parsed once
    named = F.struct(F.col("__first"), F.col("__key"))
    names = _first_seen(df, order, "__cells").agg(F.transform(F.sort_array(F.collect_list(named)), lambda n: n["__key"]).alias("names"))
    names = cut_lineage(names)
    places = names.select(F.posexplode("names").alias("__place", "__name"))
    long_form = df.select("__row", *order, F.explode_outer("__cells").alias("__name", "__value"))
    cell = F.when(F.col("__value") != "", F.struct(F.col("__place").alias("place"), F.col("__value").alias("value")))
    rows = long_form.join(places, "__name", "left").groupBy("__row").agg(
        *[F.first(c).alias(c) for c in order], F.sort_array(F.collect_list(cell)).alias("__found")
    )
    header = F.array_join(F.transform("names", _csv_cell), ",").alias("__header")
    absent = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in [*order, "__found"]]
    rows = rows.select(F.lit(1).alias("part"), *order, "__found", F.lit(None).cast("string").alias("__header"))
    rows = rows if df.isEmpty() else rows.unionByName(names.select(F.lit(0).alias("part"), *absent, header))
    # a stated number of ranges: by the size of the cells alone, the adaptive planner would make all lines in a few tasks
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(ranges, "part", *order).sortWithinPartitions("part", *order)
    before = lambda i: F.coalesce(F.get("__found", i - 1)["place"], F.lit(0))
    pieces = F.transform("__found", lambda c, i: F.concat(F.repeat(F.lit(","), c["place"] - before(i)), c["value"]))
    rest = F.repeat(F.lit(","), names.select(F.size("names")).scalar() - 1 - before(F.size("__found")))
    row = F.concat(F.array_join(pieces, ""), rest)
    return placed.select("part", *order, F.when(F.col("part") == 0, F.col("__header")).otherwise(row).alias("line"))


def write_wide_csv(
    df: DataFrame, path: str, order: Sequence[str], cells: str = "cells", mode: str = "error", compression: str | None = None
) -> None:
    """The table of all cells as CSV with one header line, however many names it has. It is rows times names large and mostly
    commas, which a ``compression`` makes small."""
    write_lines(wide_lines(df, order, cells), "line", path, mode=mode, compression=compression)


def write_lines(
    df: DataFrame, line: str, path: str, order: Sequence[str] = (), mode: str = "error", compression: str | None = None
) -> None:
    """One text column as lines (NDJSON or plain text)."""
    (df.orderBy(*order) if order else df).select(line).write.mode(mode).text(path, compression=compression)


def write_payloads(df: DataFrame, body: str, kind: str, path: str, mode: str = "error") -> None:
    """Payloads in one folder per route, see ``route_kind``."""
    from ..functions.kinds import route_kind

    routed = df.withColumn("route", F.coalesce(F.nullif(route_kind(F.col(kind)), F.lit("")), F.lit("root")))
    routed.write.mode(mode).partitionBy("route").parquet(path)


# -- envelopes -------------------------------------------------------------------------


def body_as_json(body: Column) -> Column:
    """A payload as a JSON value: JSON as it is (on one line), anything else as a JSON text."""
    text = F.coalesce(decode_lossy(body), F.lit(""))
    # line ends inside valid JSON are blanks between its tokens
    one_line = F.btrim(F.translate(text, "\r\n", "  "))
    return F.when(strict_json(text).isNotNull(), one_line).otherwise(quote_json(text))


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def _member(name: str, value: Column) -> Column:
    return F.concat(quote_json(F.lit(name)), F.lit(": "), F.coalesce(value, F.lit("null")))


def _line(members: Sequence[Column]) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def _head_members() -> list[Column]:
    return [
        _member("index", (F.col("index") + 1).cast("string")),
        _member("input", quote_json(F.col("input"))),
        _member("status_code", F.col("status_code").cast("string")),
    ]


def _tail_members() -> list[Column]:
    return [
        _member("error", quote_json(F.col("error"))),
        _member("fetched_at", quote_json(iso_timestamp(F.col("fetched_at")))),
        _member("latency_ms", F.col("latency_ms").cast("string")),
    ]


def result_envelope(responses: DataFrame) -> DataFrame:
    """``index, line``: every response that was not skipped as one JSON line."""
    members = [*_head_members(), _member("body", body_as_json(F.col("body"))), *_tail_members()]
    return responses.filter(~F.col("skipped")).select("index", _line(members).alias("line"))


def _resolved_fields(responses: DataFrame, fields: Mapping[str, Path]) -> tuple[DataFrame, list[str]]:
    df, parts = parsed(spread_small(responses).filter(~F.col("skipped")), "body"), []
    for i, expression in enumerate(fields.values()):
        df = resolve_json(df, expression, f"__f{i}")
        parts.append(f"__f{i}")
    return df, parts


def _is_blank_body() -> Column:
    return F.coalesce(F.octet_length(F.col("body").cast("binary")) == 0, F.lit(True))


def envelope_promote_fields(responses: DataFrame, fields: Mapping[str, Path]) -> DataFrame:
    """Like ``result_envelope`` with the named paths in place of the body (null where unmatched);
    a body that is no JSON keeps the plain layout."""
    df, parts = _resolved_fields(responses, fields)
    promoted = [_member(name, value_json(part)) for name, part in zip(fields, parts)]
    plain = _line([*_head_members(), _member("body", body_as_json(F.col("body"))), *_tail_members()])
    lined = _line([*_head_members(), *promoted, *_tail_members()])
    usable = F.col("__v").isNotNull() | _is_blank_body()
    return df.select("index", F.when(usable, lined).otherwise(plain).alias("line"))


def results_table(responses: DataFrame, fields: Mapping[str, Path] | None = None) -> DataFrame:
    """Table form of the results: index, input, status_code, body or the named fields, error.

    Where fields are asked for and the body is no JSON, its text stands in the first field.
    """
    text = F.coalesce(decode_lossy(F.col("body")), F.lit(""))
    head = [(F.col("index") + 1).alias("index"), "input", "status_code"]
    error = F.coalesce("error", F.lit("")).alias("error")
    if not fields:
        return responses.filter(~F.col("skipped")).select(*head, text.alias("body"), error)
    df, parts = _resolved_fields(responses, fields)
    usable = F.col("__v").isNotNull() | _is_blank_body()
    cells = [
        F.when(usable, F.coalesce(value_text(part), F.lit("")))
        .otherwise(text if i == 0 else F.lit(""))
        .alias(name)
        for i, (name, part) in enumerate(zip(fields, parts))
    ]
    return df.select(*head, *cells, error)


def result_counts(responses: DataFrame) -> DataFrame:
    """One row: succeeded and failed, skipped rows aside."""
    return responses.filter(~F.col("skipped")).agg(
        F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed")
    )
