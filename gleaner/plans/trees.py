"""Shredding (D) and path steps (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.formats import ndjson_list
from ..functions.text import matches, split_lines
from ..operators import markdown, steps, variant_paths
from ..operators.catalog import corpus_schema, node_paths
from ..operators.links import unwrap_envelope
from ..operators.rows import spread_small
from ..operators.shred import explode_nodes, shred
from ..operators.steps import Path, path
from .base import ORDER_DOCS_SQL, order_documents, query, table


def order_trees(spark, sf, *paths: Path):
    """The order documents, shredded as far as the given paths reach (whole without any)."""
    docs = order_documents(spark, sf)
    return steps.shred_for(docs, "body", *paths, format="json") if paths else shred(docs, "body", "json")


# -- D: shredding ----------------------------------------------------------------------

_ORDER_JSON = """
j AS (SELECT id, json_object('id', id, 'customer', json_object('key', ck, 'full.name', 'Customer ' || ck, 'rank', code),
        'status', st, 'tags', (SELECT to_json(list(tag ORDER BY pos)) FROM t WHERE t.id = o.id),
        'amounts', (SELECT to_json(list(json_object('name', name, 'cents', c, 'paid', CASE paid WHEN 'True' THEN true WHEN 'False' THEN false END) ORDER BY pos)) FROM a WHERE a.id = o.id),
        'groups', json_array(json_array(code, code + 1), json_array(code + 2)), 'note', NULL,
        'raw', '{"code": ' || code || ', "flags": ["' || st || '", "x"], "inner": "[' || id % 10 || ', 7]"}') AS doc FROM o)
"""


@query(
    "shred_json",
    f"""WITH {ORDER_DOCS_SQL}, {_ORDER_JSON},
    n AS (SELECT j.id, e.type, e.key FROM j, json_tree(j.doc) e)
    SELECT id, count(*) AS nodes, count(*) FILTER (type IN ('OBJECT')) AS dicts, count(*) FILTER (type = 'ARRAY') AS lists,
           count(*) FILTER (type = 'VARCHAR') AS strings, count(*) FILTER (type IN ('BIGINT', 'UBIGINT', 'HUGEINT')) AS ints,
           count(*) FILTER (type = 'NULL') AS nulls, count(*) FILTER (type = 'BOOLEAN') AS bools FROM n GROUP BY id""",
)
def shred_json(spark, sf):
    # counted inside the row: a document's nodes never have to meet again
    count = lambda kind: F.expr(f"cast(size(own) - size(array_remove(own, '{kind}')) as bigint)")
    own = order_trees(spark, sf).select("id", F.expr("filter(tree.nodes, n -> not n.embedded).kind").alias("own"))
    names = {"dicts": "dict", "lists": "list", "strings": "str", "ints": "int", "nulls": "null", "bools": "bool"}
    return own.select("id", F.size("own").cast("long").alias("nodes"), *[count(k).alias(n) for n, k in names.items()])


@query(
    "shred_ndjson",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'ndjson' END AS format,
              CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
              CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS kind FROM events""",
)
def shred_ndjson(spark, sf):
    lines = table(spark, sf, "events").selectExpr(
        "event_id",
        """concat(props, '\\n\\n  {"kind": "', event_type, '"}\\n', if(event_id % 10 = 0, '{broken', '')) as body""",
    )
    lists = variant_paths.parsed(spread_small(lines).withColumn("list", ndjson_list(F.col("body"))), "list")
    df = variant_paths.resolve_json(variant_paths.resolve_json(lists, path("k"), "k"), path("kind"), "kind")
    value = lambda c: F.expr(f"get({c}.items, 0).text")
    format_ = F.when(F.col("list").isNotNull(), "ndjson").alias("format")
    return df.select("event_id", format_, value("k").cast("long").alias("k"), value("kind").alias("kind"))


@query(
    "shred_csv",
    """SELECT c_custkey, CAST(0 AS INTEGER) AS item, 'Customer, ' || c_custkey AS name, c_mktsegment AS segment FROM customer WHERE c_custkey % 5 <> 0
       UNION ALL SELECT c_custkey, 1, 'second "row"', '' FROM customer WHERE c_custkey % 5 <> 0""",
)
def shred_csv(spark, sf):
    payloads = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        '''if(c_custkey % 5 = 0, concat('only one column\\n', c_name),
              concat('name,segment\\r\\n"Customer, ', c_custkey, '",', c_mktsegment, '\\r\\n"second ""row""",\\r\\n')) as body''',
    )
    rows = shred(payloads, "body", "csv", split_lists=True).filter("item is not null")
    df = steps.resolve(steps.resolve(rows, path("name"), "n"), path("segment"), "s")
    return df.select("c_custkey", "item", F.expr("get(n.items, 0).text").alias("name"), F.expr("get(s.items, 0).text").alias("segment"))


@query(
    "shred_html",
    r"""SELECT page_id, len(regexp_extract_all(html, '(?i)<a\s+[^>]*href\s*=\s*["'']([^"'']+)["'']', 1)) AS hrefs,
              regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages""",
)
def shred_html(spark, sf):
    trees = shred(table(spark, sf, "pages").select("page_id", "html"), "html", "html")
    return trees.select(
        "page_id",
        F.expr("cast(size(filter(tree.nodes, n -> n.key = 'href')) as bigint)").alias("hrefs"),
        F.expr("element_at(filter(tree.nodes, n -> n.key = 'lang' and n.depth = 1), 1).sval").alias("lang"),
    )


@query(
    "shred_xml",
    """SELECT page_id, url AS loc, 'page ' || page_id AS title, CAST(page_id % 3 + 1 AS BIGINT) AS tags FROM pages WHERE page_id % 7 <> 0""",
)
def shred_xml(spark, sf):
    payloads = table(spark, sf, "pages").selectExpr(
        "page_id",
        """concat('<?xml version="1.0"?><item loc="', replace(url, '&', '&amp;'), '"><!-- note --><title> page ', page_id, ' </title>',
                  repeat('<tag>t</tag>', page_id % 3 + 1), if(page_id % 7 = 0, '<open>', ''), '</item>') as body""",
    )
    trees = shred(payloads, "body", "xml").filter("tree.format is not null")
    value = lambda key: F.expr(f"element_at(filter(tree.nodes, n -> n.key = '{key}'), 1).sval")
    tags = F.expr("cast(greatest(1, size(element_at(filter(tree.nodes, n -> n.key = 'tag'), 1).kids)) as bigint)")
    return trees.select("page_id", value("loc").alias("loc"), value("title").alias("title"), tags.alias("tags"))


_MD_BODY = """concat('preface ', doc_id, '\\n# Title ', doc_id, '\\nintro\\n\\n## Same\\nfirst ', lang, '\\n## Same\\nsecond\\n### Deep\\n',
    replace(replace(replace(text, '#', ''), '|', ''), '\\n', ' '), '\\nSetext\\n======\\n| name | size |\\n|---|:-:|\\n| ', source, ' | ', n_chars, ' |\\n| short |\\nafter\\n') as body"""


# the document's text stands in one line, without the signs of headings and tables
_MD_DEEP_SQL = "trim(replace(replace(replace(text, '#', ''), '|', ''), chr(10), ' '), ' ' || chr(9) || chr(13) || chr(12) || chr(11))"


@query(
    "shred_markdown",
    f"""
    SELECT doc_id, 'text' AS path, 'preface ' || doc_id AS value FROM documents
    UNION ALL SELECT doc_id, 'Title ' || doc_id || '.text', 'intro' FROM documents
    UNION ALL SELECT doc_id, 'Title ' || doc_id || '.Same.text', 'first ' || lang FROM documents
    UNION ALL SELECT doc_id, 'Title ' || doc_id || '.Same (2).text', 'second' FROM documents
    UNION ALL SELECT doc_id, 'Title ' || doc_id || '.Same (2).Deep.text', {_MD_DEEP_SQL} FROM documents WHERE {_MD_DEEP_SQL} <> ''
    UNION ALL SELECT doc_id, 'Setext.tables.0.name', source FROM documents
    UNION ALL SELECT doc_id, 'Setext.tables.0.size', CAST(n_chars AS VARCHAR) FROM documents
    UNION ALL SELECT doc_id, 'Setext.tables.1.name', 'short' FROM documents
    UNION ALL SELECT doc_id, 'Setext.tables.1.size', '' FROM documents
    UNION ALL SELECT doc_id, 'Setext.text', 'after' FROM documents
    """,
)
def shred_markdown(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", _MD_BODY)
    nodes = explode_nodes(shred(docs, "body", "markdown", paths=True), "doc_id")
    leaves = nodes.filter("kind = 'str'")
    return leaves.select("doc_id", "path", F.col("sval").alias("value"))


@query(
    "markdown_sections",
    f"""
    SELECT doc_id, CAST(0 AS INTEGER) AS section, CAST(0 AS INTEGER) AS level, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS INTEGER) AS parent, md5('preface ' || doc_id) AS text_md5 FROM documents
    UNION ALL SELECT doc_id, 1, 1, 'Title ' || doc_id, 0, md5('intro') FROM documents
    UNION ALL SELECT doc_id, 2, 2, 'Same', 1, md5('first ' || lang) FROM documents
    UNION ALL SELECT doc_id, 3, 2, 'Same', 1, md5('second') FROM documents
    UNION ALL SELECT doc_id, 4, 3, 'Deep', 3, md5({_MD_DEEP_SQL}) FROM documents
    UNION ALL SELECT doc_id, 5, 1, 'Setext', 0, md5('after') FROM documents
    """,
)
def markdown_sections(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", _MD_BODY)
    return markdown.markdown_sections(docs, "body", "doc_id").withColumn("text_md5", F.md5("text")).drop("text")


@query(
    "markdown_tables",
    """
    SELECT doc_id, CAST(0 AS INTEGER) AS "table", CAST(0 AS INTEGER) AS row, source AS name, CAST(n_chars AS VARCHAR) AS size FROM documents
    UNION ALL SELECT doc_id, 0, 1, 'short', '' FROM documents
    """,
)
def markdown_tables(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", _MD_BODY)
    rows = markdown.markdown_tables(docs, "body", "doc_id")
    return rows.select("doc_id", "table", "row", F.col("cells")["name"].alias("name"), F.col("cells")["size"].alias("size"))


@query(
    "shred_text",
    r"""WITH l AS (SELECT doc_id, str_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS lines FROM documents),
    m AS (SELECT doc_id, CASE WHEN lines[len(lines)] = '' THEN lines[:len(lines) - 1] ELSE lines END AS lines FROM l)
    SELECT doc_id, CAST(unnest(range(len(lines))) AS BIGINT) AS pos, unnest(lines) AS line FROM m""",
)
def shred_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    return lines.withColumn("pos", F.col("pos").cast("long"))


@query(
    "unwrap_json_envelope",
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN coalesce(nullif(text, ''), 'no') WHEN 1 THEN nullif(text, '') END AS inner_text FROM documents""",
)
def unwrap_json_envelope(spark, sf):
    wrapped = table(spark, sf, "documents").selectExpr(
        "doc_id",
        """case doc_id % 5 when 0 then concat(' {"content": "no", "body": ', substring(to_json(array(text)), 2, length(to_json(array(text))) - 2), '}')
             when 1 then to_json(named_struct('body', '', 'content', text))
             when 2 then concat('{"body": {"nested": ', to_json(array(text)), '}, "content": 5}')
             when 3 then to_json(array(text)) else text end as body""",
    )
    return wrapped.select("doc_id", unwrap_envelope(F.col("body")).alias("inner_text"))


@query(
    "node_path_catalog",
    f"""WITH {ORDER_DOCS_SQL}, n AS (SELECT count(*) AS n FROM orders),
    third AS (SELECT count(*) AS n FROM (SELECT id FROM a GROUP BY id HAVING count(*) > 2)),
    tags AS (SELECT pos, count(*) AS n FROM t GROUP BY pos)
    SELECT p AS path, n AS documents FROM n, unnest(['[keys]', '[values]', 'id', 'customer', 'customer[keys]', 'customer[values]',
        'customer.key', 'customer.(full.name)', 'customer.rank', 'status', 'amounts', 'amounts[0]', 'amounts[1]', 'amounts[keys]',
        'amounts[values]', 'amounts.name', 'amounts.cents', 'amounts.paid', 'tags', 'groups', 'groups[0]', 'groups[1]',
        'note', 'raw', 'raw[keys]', 'raw[values]', 'raw.code', 'raw.flags', 'raw.flags[0]', 'raw.flags[1]', 'raw.inner']) AS u(p)
    UNION ALL SELECT 'amounts[2]', n FROM third WHERE n > 0
    UNION ALL SELECT 'tags[' || pos || ']', n FROM tags""",
)
def node_path_catalog(spark, sf):
    return node_paths(order_trees(spark, sf)).groupBy("path").agg(F.count("*").alias("documents"))


@query(
    "corpus_schema",
    """SELECT 'OBJECT<amounts: ARRAY<OBJECT<cents: BIGINT, name: STRING, paid: BOOLEAN>>, customer: OBJECT<`full.name`: STRING, key: BIGINT, '
        || 'rank: BIGINT>, groups: ARRAY<ARRAY<BIGINT>>, id: BIGINT, note: VOID, raw: STRING, status: STRING, tags: ARRAY<STRING>>' AS schema,
        count(*) AS documents FROM orders""",
)
def corpus_schemas(spark, sf):
    return corpus_schema(order_documents(spark, sf), "body")


# -- E: path steps ---------------------------------------------------------------------


def step_query(name: str, expression: Path, oracle: str) -> None:
    """Register the values of one path over the order documents: id, ord, value. Searches and ancestors run over trees, which
    hold every node's place; all other paths are compiled to VARIANT."""

    @query(name, f"WITH {ORDER_DOCS_SQL} SELECT CAST(id AS BIGINT) AS id, CAST(ord AS BIGINT) AS ord, CAST(value AS VARCHAR) AS value FROM ({oracle})")
    def run(spark, sf):
        if any(step in ("recurse", "up") for step, _ in expression.calls):
            values = steps.extract_values(order_trees(spark, sf, expression), expression, "id")
        else:
            values = variant_paths.json_values(order_documents(spark, sf), "body", expression, "id")
        return values.select("id", F.col("ord").cast("long").alias("ord"), "value")


step_query("step_key", path("amounts").key("cents"), "SELECT id, pos AS ord, c AS value FROM a")
step_query("step_escaped_key", path("customer").key("full.name"), "SELECT id, 0 AS ord, 'Customer ' || ck AS value FROM o")
step_query(
    "step_keys",
    path("amounts").keys(),
    "SELECT id, pos * 3 + k AS ord, v AS value FROM a, (VALUES (0, 'name'), (1, 'cents'), (2, 'paid')) AS k(k, v)",
)
step_query(
    "step_values",
    path("customer").values(),
    """SELECT id, 0 AS ord, CAST(ck AS VARCHAR) AS value FROM o UNION ALL SELECT id, 1, 'Customer ' || ck FROM o
       UNION ALL SELECT id, 2, CAST(code AS VARCHAR) FROM o""",
)
step_query("step_recurse", Path().recurse("cents"), "SELECT id, pos AS ord, c AS value FROM a")
step_query(
    "step_recurse_glob",
    Path().recurse("*ame"),
    "SELECT id, 0 AS ord, 'Customer ' || ck AS value FROM o UNION ALL SELECT id, pos + 1, name FROM a",
)
step_query("step_recurse_up", Path().recurse_up("cents", 3).key("id"), "SELECT id, pos AS ord, id AS value FROM a")
step_query("step_index", path("tags").index(-1), "SELECT id, 0 AS ord, label AS value FROM o")
step_query(
    "step_multi_index",
    path("amounts").pick(2, 0, 9).key("name"),
    """SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos DESC) - 1 AS ord, name AS value FROM a WHERE pos IN (0, 2)""",
)
step_query("step_slice", path("amounts").slice(1, None).key("cents"), "SELECT id, pos - 1 AS ord, c AS value FROM a WHERE pos >= 1")
step_query(
    "where_value",
    path("tags").where_value("*g*"),
    "SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS ord, tag AS value FROM t WHERE contains(tag, 'g')",
)
step_query(
    "where_value_not",
    path("tags").where_value_not("urg"),
    "SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS ord, tag AS value FROM t WHERE NOT contains(tag, 'urg')",
)
step_query(
    "where_child",
    path("amounts").where_child("name", "/^(rest|units)$/").key("cents"),
    "SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS ord, c AS value FROM a WHERE name IN ('rest', 'units')",
)
step_query(
    "where_child_not",
    path("amounts").where_child_not("paid", "False").key("name"),
    "SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS ord, name AS value FROM a WHERE paid IS DISTINCT FROM 'False'",
)
step_query(
    "where_any_child",
    path("amounts").where_child("*a*", "*t*").key("cents"),
    "SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS ord, c AS value FROM a WHERE contains(name, 't')",
)
step_query(
    "step_up",
    Path().recurse("cents").where_value("/^[0-6]$/").up(1).key("name"),
    "SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS ord, name AS value FROM a WHERE c BETWEEN 0 AND 6",
)
step_query(
    "step_embedded_json",
    path("raw", "inner"),
    "SELECT id, 0 AS ord, id % 10 AS value FROM o UNION ALL SELECT id, 1, 7 FROM o",
)
step_query(
    "extract_values",
    path("groups"),
    "SELECT id, 0 AS ord, '[' || code || ', ' || (code + 1) || ']' AS value FROM o UNION ALL SELECT id, 1, '[' || (code + 2) || ']' FROM o",
)


def _combined(spark, sf, combine, *expressions):
    df = combine(variant_paths.parsed(order_documents(spark, sf), "body"), *expressions, out="found")
    return steps.explode_values(df, "found", "id").select("id", F.col("ord").cast("long").alias("ord"), "value")


@query(
    "paths_or",
    f"""WITH {ORDER_DOCS_SQL}, u AS (SELECT id, pos AS p, tag AS value FROM t WHERE contains(tag, 'big') UNION ALL SELECT id, 10, CAST(ck AS VARCHAR) FROM o)
    SELECT id, row_number() OVER (PARTITION BY id ORDER BY p) - 1 AS ord, value FROM u""",
)
def paths_or(spark, sf):
    return _combined(spark, sf, variant_paths.json_any_of, path("tags").where_value("big"), path("missing"), path("customer", "key"))


@query(
    "paths_and",
    f"""WITH {ORDER_DOCS_SQL} SELECT id, CAST(0 AS BIGINT) AS ord, 'urgent' AS value FROM o WHERE code <= 2 AND st = 'F'
    UNION ALL SELECT id, 1, 'F' FROM o WHERE code <= 2 AND st = 'F'""",
)
def paths_and(spark, sf):
    return _combined(spark, sf, variant_paths.json_all_of, path("tags").where_value("urgent"), path("status").where_value("F"))


_PATTERNS = {"sub": "tion", "glob": "*[aeiou]n*the*", "glob_end": "*.", "regex": r"/\bth\w+\s/", "bad": "/[oops/"}


@query(
    "match_pattern",
    r"""SELECT doc_id, contains(text, 'tion') AS sub, regexp_matches(text, '(?s)^.*[aeiou]n.*the.*$') AS glob,
       ends_with(text, '.') AS glob_end, regexp_matches(text, '(?:^|[^\pL\pN_])th[\pL\pN_\pM]+\s') AS regex, false AS bad FROM documents""",
)
def match_pattern(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", *[matches(F.col("text"), p).alias(n) for n, p in _PATTERNS.items()])


@query(
    "extract_schema",
    f"""WITH {ORDER_DOCS_SQL},
    big AS (SELECT id FROM t WHERE tag = 'big')
    SELECT id, '{{"customer": ' || ck || CASE WHEN id IN (SELECT id FROM big) THEN ', "big": ["big"]' ELSE '' END
        || ', "names": [' || (SELECT string_agg('"' || name || '"', ', ' ORDER BY pos) FROM a WHERE a.id = o.id) || '], "none": []}}' AS record
    FROM o""",
)
def extract_schema(spark, sf):
    schema = {
        "customer": path("customer", "key"),
        "big": path("tags").where_value("big"),
        "missing": path("customer", "zip"),
        "names": path("amounts", "name"),
        "none": path("tags").slice(9, None),
    }
    return variant_paths.json_schema(order_documents(spark, sf), "body", schema, "id")


@query(
    "filter_fields",
    f"""WITH {ORDER_DOCS_SQL}
    SELECT id, CAST(0 AS INTEGER) AS item, '{{"status": "' || st || '"}}' AS filtered FROM o WHERE id % 3 = 0
    UNION ALL SELECT id, 1, '{{}}' FROM o WHERE id % 3 = 0
    UNION ALL SELECT id, 2, '{{"rank": ' || code || '}}' FROM o WHERE id % 3 = 0
    UNION ALL SELECT id, NULL, '{{"status": "' || st || '", "rank": ' || code || '}}' FROM o WHERE id % 3 = 1
    UNION ALL SELECT id, NULL, 'no json ' || id FROM o WHERE id % 3 = 2""",
)
def filter_fields(spark, sf):
    docs = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "o_orderstatus as st", "substring(o_orderpriority, 1, 1) as code"
    )
    payloads = docs.selectExpr(
        "id",
        """case id % 3
             when 0 then concat('[{"status": "', st, '", "x": 1}, 5, {"customer": {"rank": ', code, '}, "status": null}]')
             when 1 then concat('{"customer": {"rank": ', code, '}, "status": "', st, '"}')
             else concat('no json ', id) end as body""",
    )
    fields = {"status": path("status"), "rank": path("customer", "rank")}
    return variant_paths.json_fields(payloads, "body", fields)


@query(
    "rebuild_subtree",
    f"""WITH {ORDER_DOCS_SQL}
    SELECT id, '{{"key": ' || ck || ', "full.name": "Customer ' || ck || '", "rank": ' || code || '}}' AS customer,
           '{{"id": ' || id || ', "customer": {{"key": ' || ck || ', "full.name": "Customer ' || ck || '", "rank": ' || code || '}}}}' AS head FROM o""",
)
def rebuild_subtree(spark, sf):
    docs = variant_paths.parsed(order_documents(spark, sf), "body")
    df = variant_paths.resolve_json(variant_paths.resolve_json(docs, path("customer"), "c"), Path().slice(0, 2), "h")
    return df.select("id", steps.value_json("c").alias("customer"), steps.value_json("h").alias("head"))


@query("variant_fast_path", "SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def variant_fast_path(spark, sf):
    return steps.fast_values(order_documents(spark, sf), "body", path("customer", "key"), "customer", ("id",))
