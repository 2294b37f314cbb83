"""Row shaping and export (F)."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ..operators import records, shape
from ..operators.links import count_links, html_links
from ..operators.rows import spread_in_order
from ..operators.shred import shred
from ..operators.steps import path
from .base import ORDER_DOCS_SQL, RESPONSES_SQL, event_responses, order_documents, query, scratch, table


def _payloads(spark, sf):
    """Order documents as numbered files: objects, lists and plain text; half have a URL."""
    return order_documents(spark, sf).selectExpr(
        "id as n",
        "concat(id, '.json') as file",
        """case id % 3 when 0 then get_json_object(body, '$.customer')
             when 1 then concat('[', id, ',"x"]') else concat('text ', id) end as body""",
    )


def _manifest(spark, sf):
    return table(spark, sf, "orders").filter("o_orderkey % 2 = 0").selectExpr(
        "concat('https://a.com/', o_orderkey) as input", "concat(o_orderkey, '.json') as file"
    )


@query(
    "merge_records",
    f"""WITH {ORDER_DOCS_SQL}, m AS (SELECT *, CASE WHEN id % 2 = 0 THEN '"_url": "https://a.com/' || id || '"' END AS u,
        '"key": ' || ck || ', "full.name": "Customer ' || ck || '", "rank": ' || code AS cust FROM o)
    SELECT id AS n, CASE id % 3
        WHEN 0 THEN '{{' || cust || CASE WHEN u IS NULL THEN '' ELSE ', ' || u END || '}}'
        WHEN 1 THEN CASE WHEN u IS NULL THEN '[' || id || ', "x"]' ELSE '{{' || u || ', "data": [' || id || ', "x"]}}' END
        ELSE '{{"content": "text ' || id || '"' || CASE WHEN u IS NULL THEN '' ELSE ', ' || u END || '}}' END AS record FROM m""",
)
def merge_records(spark, sf):
    named = shape.with_source_url(_payloads(spark, sf), _manifest(spark, sf))
    return records.merge_json_records(named, "body", "url", "n")


@query(
    "merge_text",
    """SELECT doc_id AS n, CASE WHEN doc_id % 2 = 0 THEN '# https://a.com/' || doc_id || chr(10) ELSE '' END || 'first ' || lang || chr(10)
       || 'second ' || source || chr(10) AS text FROM documents""",
)
def merge_text(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id as n", "concat('first ', lang, '\\r\\n', 'second ', source, '\\n') as body",
        "if(doc_id % 2 = 0, concat('https://a.com/', doc_id), null) as url",
    )
    return shape.merge_text(docs, "body", "url", "n")


_SCALARS = "'a', 1, 'b', 2, 'c', 3, 'd', 4, 'e', 5, 'f', 6, 'g', 7, 'h', 8, 'i', 9"
_LISTS = """filter(array(named_struct('v', 1), named_struct('v', 2), named_struct('v', 3), named_struct('v', 4)), x -> x.v <= o_custkey % 5)"""


@query(
    "main_list",
    """SELECT o_orderkey AS id, CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'products'
          WHEN o_custkey % 5 > 2 THEN 'rows' ELSE 'other' END AS main FROM orders WHERE o_orderkey % 4 <> 1
       UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 1""",
)
def main_list(spark, sf):
    two = "array(named_struct('v', 'x'), named_struct('v', 'y'))"
    docs = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id",
        f"""case when o_orderkey % 2 = 0 then to_json(named_struct({_SCALARS}, 'words', array('p', 'q', 'r', 's', 't'), 'products', {_LISTS}))
                 when o_orderkey % 4 = 1 then to_json(named_struct({_SCALARS}, 'rows', {_LISTS}))
                 else to_json(named_struct('id', 1, 'other', if(o_custkey % 5 = 0, array(), {two}), 'rows', {_LISTS})) end as body""",
    )
    return records.main_list_key(docs, "body", "main").select("id", "main")


@query(
    "explode_records",
    f"""WITH {ORDER_DOCS_SQL}
    SELECT id, CAST(pos AS INTEGER) AS rec, '{{"name": "' || name || '", "cents": ' || c || ', "paid": ' || coalesce(lower(paid), 'null') || '}}' AS record FROM a""",
)
def explode_records(spark, sf):
    return records.explode_json_records(order_documents(spark, sf), "body", "id")


def _nested(spark, sf):
    """The order document one level down, so that the document itself is the record."""
    docs = order_documents(spark, sf).selectExpr("id", """concat('{"doc": ', body, ', "extra": {"empty": [], "mix": [1, {"k": 2}, [3], null]}}') as body""")
    return shred(docs, "body", "json", paths=True, embedded=False)


_FLAT_SQL = """
    SELECT id, 'doc.id' AS key, CAST(id AS VARCHAR) AS value FROM o
    UNION ALL SELECT id, 'doc.customer.key', CAST(ck AS VARCHAR) FROM o
    UNION ALL SELECT id, 'doc.customer.full.name', 'Customer ' || ck FROM o
    UNION ALL SELECT id, 'doc.customer.rank', CAST(code AS VARCHAR) FROM o
    UNION ALL SELECT id, 'doc.status', st FROM o
    UNION ALL SELECT id, 'doc.amounts.' || pos || '.name', name FROM a
    UNION ALL SELECT id, 'doc.amounts.' || pos || '.cents', CAST(c AS VARCHAR) FROM a
    UNION ALL SELECT id, 'doc.amounts.' || pos || '.paid', coalesce(paid, '') FROM a
    UNION ALL SELECT id, 'doc.tags', '[''' || string_agg(tag, ''', ''' ORDER BY pos) || ''']' FROM t GROUP BY id
    UNION ALL SELECT id, 'doc.groups.0', '[' || code || ', ' || (code + 1) || ']' FROM o
    UNION ALL SELECT id, 'doc.groups.1', '[' || (code + 2) || ']' FROM o
    UNION ALL SELECT id, 'doc.note', '' FROM o
    UNION ALL SELECT id, 'doc.raw', '{"code": ' || code || ', "flags": ["' || st || '", "x"], "inner": "[' || id % 10 || ', 7]"}' FROM o
    UNION ALL SELECT id, 'extra.empty', '' FROM o UNION ALL SELECT id, 'extra.mix.0', '1' FROM o UNION ALL SELECT id, 'extra.mix.1.k', '2' FROM o
    UNION ALL SELECT id, 'extra.mix.2', '[3]' FROM o UNION ALL SELECT id, 'extra.mix.3', '' FROM o
"""


@query("flatten_dotted", f"WITH {ORDER_DOCS_SQL} {_FLAT_SQL}")
def flatten_dotted(spark, sf):
    return shape.explode_cells(shape.flatten_records(_nested(spark, sf), "id"), "id").select("id", "key", "value")


@query(
    "flatten_to_depth",
    f"""WITH {ORDER_DOCS_SQL}, am AS (SELECT id, '[' || string_agg('{{"name": "' || name || '", "cents": ' || c || ', "paid": ' || coalesce(lower(paid), 'null') || '}}', ', ' ORDER BY pos) || ']' AS v FROM a GROUP BY id)
    SELECT * FROM ({_FLAT_SQL}) WHERE key NOT LIKE 'doc.customer.%' AND key NOT LIKE 'doc.amounts.%' AND key NOT LIKE 'doc.groups.%' AND key NOT LIKE 'extra.mix.%'
    UNION ALL SELECT id, 'extra.mix', '[1, {{"k": 2}}, [3], null]' FROM o
    UNION ALL SELECT id, 'doc.amounts', v FROM am
    UNION ALL SELECT id, 'doc.groups', '[[' || code || ', ' || (code + 1) || '], [' || (code + 2) || ']]' FROM o
    UNION ALL SELECT id, 'doc.customer', '{{"key": ' || ck || ', "full.name": "Customer ' || ck || '", "rank": ' || code || '}}' FROM o""",
)
def flatten_to_depth(spark, sf):
    return shape.explode_cells(shape.flatten_records(_nested(spark, sf), "id", max_depth=1), "id").select("id", "key", "value")


@query(
    "max_nesting_depth",
    f"""WITH {ORDER_DOCS_SQL} SELECT id, CAST(pos AS INTEGER) AS rec, CAST(0 AS INTEGER) AS depth FROM a WHERE id % 4 = 0
    UNION ALL SELECT id, 0, CAST(id % 4 + 1 AS INTEGER) FROM o WHERE id % 4 > 0""",
)
def max_nesting_depth(spark, sf):
    # the order document, up to three levels down; at the top its main list gives the records
    nested = """concat(repeat('{"k": ', cast(id % 4 as int)), body, repeat('}', cast(id % 4 as int))) as body"""
    return records.record_depths(order_documents(spark, sf).selectExpr("id", nested), "body", "id")


@query(
    "depth_guard",
    """SELECT o_orderkey AS id, 'a.b.c.d.e.f' AS key, CAST(o_custkey AS VARCHAR) AS value FROM orders WHERE o_orderkey % 3 > 0
    UNION ALL SELECT o_orderkey, 'refused', 'true' FROM orders WHERE o_orderkey % 3 = 0""",
)
def depth_guard(spark, sf):
    """Five levels pass the guard. Six fail the job, and get through when a depth is named."""
    docs = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", """concat('{"a": {"b": {"c": {"d": {"e": {"f": ', if(o_orderkey % 3 = 0, concat('{"g": ', o_custkey, '}'), string(o_custkey)), '}}}}}}') as body"""
    )
    deep = docs.filter("id % 3 = 0")
    try:
        records.flatten_json_records(deep, "body", "id").write.format("noop").mode("overwrite").save()
        refused = "false"
    except PySparkException as error:
        refused = str("name a depth" in str(error)).lower()
    flat = records.flatten_json_records(docs.filter("id % 3 > 0"), "body", "id")
    named = records.flatten_json_records(deep, "body", "id", max_depth=6)
    passed = shape.explode_cells(named, "id").filter("key = 'a.b.c.d.e.f.g'").select("id", F.lit("refused").alias("key"), F.lit(refused).alias("value"))
    return shape.explode_cells(flat, "id").select("id", "key", "value").unionByName(passed)


@query(
    "stringify_top_level",
    f"""WITH {ORDER_DOCS_SQL}
    SELECT id, CAST(pos AS INTEGER) AS rec, 'name' AS key, name AS value FROM a UNION ALL SELECT id, pos, 'cents', CAST(c AS VARCHAR) FROM a
    UNION ALL SELECT id, pos, 'paid', coalesce(paid, '') FROM a UNION ALL SELECT id, pos, '_url', 'https://a.com/' || id FROM a""",
)
def stringify_top_level(spark, sf):
    docs = order_documents(spark, sf).withColumn("url", F.concat(F.lit("https://a.com/"), F.col("id")))
    rows = records.stringify_json_records(docs, "body", "id", url="url")
    return shape.explode_cells(rows, "id", "rec").drop("pos")


@query(
    "dedupe_rows",
    f"""WITH {ORDER_DOCS_SQL}
    SELECT min(id) AS id, name, c AS cents, count(*) AS copies FROM a GROUP BY name, c, paid""",
)
def dedupe_rows(spark, sf):
    rows = records.stringify_json_records(order_documents(spark, sf), "body", "id")
    first = shape.dedupe_rows(rows, ["id", "rec"])
    cents = F.col("cells")["cents"].cast("bigint")
    return first.select("id", F.col("cells")["name"].alias("name"), cents.alias("cents"), "copies")


def _sparse_rows(spark, sf):
    docs = table(spark, sf, "customer").selectExpr(
        "c_custkey as id",
        "if(c_custkey % 2 = 0, concat('https://a.com/', c_custkey), null) as url",
        """concat('{"name": "', c_name, '"', if(c_custkey % 3 = 0, concat(', "segment": "', c_mktsegment, '"'), ''),
                  if(c_custkey % 5 = 0, ', "geo": {"nation": ' || c_nationkey || '}', ''), '}') as body""",
    )
    return records.flatten_json_records(docs, "body", "id", url="url")


@query(
    "select_columns",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'https://a.com/' || c_custkey ELSE '' END AS _url,
       CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS segment, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS "geo.nation",
       '' AS unknown FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0""",
)
def select_columns(spark, sf):
    return shape.select_columns(_sparse_rows(spark, sf), ["segment", "geo.nation", "unknown"], "id")


@query(
    "union_columns",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'https://a.com/' || c_custkey ELSE '' END AS _url, c_name AS name,
       CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS segment, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS "geo.nation"
       FROM customer""",
)
def union_columns(spark, sf):
    return shape.union_columns(_sparse_rows(spark, sf), ["id", "rec"], "id")


# the number of names grows with the table; each record holds two of them
@query(
    "write_wide_csv",
    """WITH r AS (SELECT c_custkey, c_name, c_mktsegment, dense_rank() OVER (ORDER BY c_custkey // 10) AS place FROM customer),
    n AS (SELECT max(place) AS n FROM r)
    SELECT '"' || c_name || ', ' || c_custkey || '"' || repeat(',', CAST(place AS INTEGER)) || c_mktsegment || repeat(',', CAST(n - place AS INTEGER)) AS line FROM r, n
    UNION ALL SELECT 'name,' || string_agg('k' || k, ',' ORDER BY k) FROM (SELECT DISTINCT c_custkey // 10 AS k FROM r)""",
)
def write_wide_csv(spark, sf):
    path_ = scratch(spark, "wide-sink")
    docs = table(spark, sf, "customer").selectExpr(
        "c_custkey as id", """concat('{"name": "', c_name, ', ', c_custkey, '", "k', c_custkey div 10, '": "', c_mktsegment, '"}') as body"""
    )
    shape.write_wide_csv(records.flatten_json_records(docs, "body", "id"), path_, ["id", "rec"], compression="gzip")
    return spark.read.text(path_).withColumnRenamed("value", "line")


@query(
    "write_csv",
    """SELECT CAST(c_custkey AS VARCHAR) AS code, c_name || ', "' || c_mktsegment || '"' AS name FROM customer""",
)
def write_csv(spark, sf):
    path_ = scratch(spark, "csv-sink")
    rows = table(spark, sf, "customer").selectExpr("c_custkey as code", """concat(c_name, ', "', c_mktsegment, '"') as name""")
    shape.write_csv(rows, path_, order=["code"])
    return spark.read.option("escape", '"').csv(path_, header=True)


@query(
    "write_ndjson",
    f"""WITH {ORDER_DOCS_SQL} SELECT id, CAST(c AS BIGINT) AS cents FROM a""",
)
def write_ndjson(spark, sf):
    path_ = scratch(spark, "ndjson-sink")
    rows = records.explode_json_records(spread_in_order(order_documents(spark, sf), "id"), "body", "id").sortWithinPartitions("id", "rec")
    merged = rows.withColumn("line", F.concat(F.lit('{"_id": '), F.col("id").cast("string"), F.lit(", "), F.expr("substring(record, 2)")))
    shape.write_lines(merged, "line", path_)
    return spark.read.schema("_id bigint, cents bigint").json(path_).withColumnRenamed("_id", "id")


_ENV_HEAD = """'{"index": ' || (index + 1) || ', "input": "' || input || '", "status_code": ' || status_code || ', '"""
_ENV_TAIL = """', "error": ' || CASE WHEN error IS NULL THEN 'null' ELSE '"' || error || '"' END || ', "fetched_at": "' ||
    strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00", "latency_ms": ' || latency_ms || '}'"""
_ENV_BODY = """'"body": ' || CASE WHEN event_type = 'click' THEN '"' || body || '"' ELSE body END"""


@query(
    "result_envelope",
    f"""WITH {RESPONSES_SQL} SELECT index, {_ENV_HEAD} || {_ENV_BODY} || {_ENV_TAIL} AS line FROM r WHERE NOT skipped""",
)
def result_envelope(spark, sf):
    return shape.result_envelope(event_responses(spark, sf))


@query(
    "envelope_promote_fields",
    f"""WITH {RESPONSES_SQL} SELECT index, {_ENV_HEAD} || CASE WHEN event_type = 'click' THEN {_ENV_BODY}
        ELSE '"k": ' || CAST(json_extract(body, '$.k') AS VARCHAR) || ', "gone": null' END || {_ENV_TAIL} AS line FROM r WHERE NOT skipped""",
)
def envelope_promote_fields(spark, sf):
    return shape.envelope_promote_fields(event_responses(spark, sf), {"k": path("k"), "gone": path("gone", "deeper")})


@query(
    "results_csv",
    f"""WITH {RESPONSES_SQL} SELECT index + 1 AS index, input, status_code, CASE WHEN event_type = 'click' THEN body
        ELSE CAST(json_extract(body, '$.k') AS VARCHAR) END AS k, '' AS gone, coalesce(error, '') AS error FROM r WHERE NOT skipped""",
)
def results_csv(spark, sf):
    return shape.results_table(event_responses(spark, sf), {"k": path("k"), "gone": path("gone")})


@query(
    "results_counts",
    f"""WITH {RESPONSES_SQL} SELECT count(*) FILTER (error IS NULL) AS succeeded, count(*) FILTER (error IS NOT NULL) AS failed FROM r WHERE NOT skipped""",
)
def results_counts(spark, sf):
    return shape.result_counts(event_responses(spark, sf))


@query(
    "count_links",
    r"""SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<a\s+[^>]*href\s*=\s*["'']([^"'']+)["'']', 1)) AS INTEGER) AS n_links FROM pages""",
)
def links_per_page(spark, sf):
    return count_links(table(spark, sf, "pages"), html_links(F.col("html")), "page_id")
