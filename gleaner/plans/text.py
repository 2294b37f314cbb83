"""Chunks (I), search results (J) and user transformations (L)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import chunks, search
from ..operators.payload import map_payload
from ..operators.steps import extract_values, path
from .base import ORDER_DOCS_SQL, query, table
from .trees import order_trees

_SIZE, _OVERLAP = 500, 100
_CHUNKS_SQL = f"""
s AS (SELECT doc_id, source, text, unnest(range(0, greatest(length(text), 1), {_SIZE - _OVERLAP})) AS start FROM documents),
c AS (SELECT doc_id, source, start // {_SIZE - _OVERLAP} AS chunk_index, substring(text, CAST(start + 1 AS BIGINT), {_SIZE}) AS content FROM s),
k AS (SELECT * FROM c WHERE content <> '')
"""


@query("chunk_text", f"WITH {_CHUNKS_SQL} SELECT doc_id, CAST(chunk_index AS INTEGER) AS chunk_index, content FROM k")
def chunk_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return chunks.chunk_records(docs, "doc_id", "text", _SIZE, _OVERLAP).selectExpr("url as doc_id", "chunk_index", "content")


@query(
    "chunk_records",
    f"""WITH {_CHUNKS_SQL} SELECT 'https://docs.example.com/' || doc_id AS url, CAST(chunk_index AS INTEGER) AS chunk_index,
        CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS total_chunks, content, TIMESTAMP '2024-05-01 12:00:00' AS fetched_at FROM k""",
)
def chunk_records(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "concat('https://docs.example.com/', doc_id) as url", "text", "timestamp_ntz'2024-05-01 12:00:00' as fetched_at"
    )
    return chunks.chunk_records(docs, "url", "text", _SIZE, _OVERLAP, "fetched_at")


@query(
    "chunk_stats",
    f"""WITH {_CHUNKS_SQL}, n AS (SELECT source, count(*) AS documents FROM documents GROUP BY source)
    SELECT n.source, n.documents, count(content) AS chunks, CAST(coalesce(sum(length(content)), 0) AS BIGINT) AS chunk_chars
    FROM n LEFT JOIN k ON k.source = n.source GROUP BY n.source, n.documents""",
)
def chunk_stats(spark, sf):
    return chunks.chunk_stats(table(spark, sf, "documents").select("source", "text"), "text", _SIZE, _OVERLAP, "source")


def _video_payloads(spark, sf):
    parts = table(spark, sf, "part").selectExpr("p_partkey as id", "p_name", "p_brand", "p_size")
    items = parts.selectExpr(
        "id",
        """to_json(array(
             named_struct('videoId', concat('vid', id), 'title', named_struct('runs', array(named_struct('text', concat('About "', p_name, '"')))),
                          'longBylineText', if(id % 2 = 0, named_struct('runs', array(named_struct('text', p_brand))), null),
                          'ownerText', named_struct('runs', array(named_struct('text', concat('owner ', p_brand)))),
                          'viewCountText', named_struct('simpleText', concat(p_size, ' views')), 'lengthText', named_struct('simpleText', '3:21')),
             named_struct('videoId', '', 'title', null, 'longBylineText', null, 'ownerText', null, 'viewCountText', null, 'lengthText', null))) as results""",
    )
    return items.selectExpr(
        "id", "if(id % 7 = 0, concat('no json ', id), to_json(named_struct('search', concat('q', id), 'results', results))) as body"
    )


@query(
    "normalize_video_results",
    """SELECT p_partkey AS id, 'https://www.youtube.com/watch?v=vid' || p_partkey AS link, 'vid' || p_partkey AS video_id, 'About "' || p_name || '"' AS title,
        CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'owner ' || p_brand END AS channel, p_size || ' views' AS views, '' AS published, '3:21' AS duration,
        'q' || p_partkey AS search, CAST(1 AS INTEGER) AS n FROM part WHERE p_partkey % 7 <> 0
       UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no json ' || p_partkey, NULL FROM part WHERE p_partkey % 7 = 0""",
)
def normalize_video_results(spark, sf):
    clean = search.normalize_video_results(_video_payloads(spark, sf), "body")
    # read back from the rewritten payload, so that its text is checked, too
    parsed = F.from_json("body", "struct<search:string,results:array<struct<" + ",".join(f"{f}:string" for f in search.VIDEO_FIELDS) + ">>>")
    rows = clean.select("id", "body", parsed.alias("d"))
    first = F.get(F.col("d.results"), F.lit(0))
    return rows.select(
        "id", *[first[f].alias(f) for f in search.VIDEO_FIELDS],
        F.when(F.col("body").startswith("no json"), F.col("body")).otherwise(F.col("d.search")).alias("search"),
        F.when(F.col("d.results").isNotNull(), F.size("d.results")).alias("n"),
    )


@query(
    "result_rows",
    f"""WITH {ORDER_DOCS_SQL} SELECT id, CAST(pos + 1 AS INTEGER) AS position, CAST(c AS BIGINT) AS cents, name FROM a""",
)
def result_rows(spark, sf):
    docs = table(spark, sf, "orders").selectExpr("o_orderkey as id", "cast(round(o_totalprice * 100) as bigint) as cents").selectExpr(
        "id",
        """to_json(named_struct('news_results', filter(array(named_struct('name', 'total', 'cents', cents), named_struct('name', 'rest', 'cents', cents % 1000),
             named_struct('name', 'units', 'cents', id % 7)), x -> x.name != 'rest' or cents % 2 = 0))) as body""",
    )
    hits = search.result_rows(docs, "body", "news", "id")
    hit = F.from_json("hit", "struct<name:string,cents:bigint>")
    return hits.select("id", "position", hit["cents"].alias("cents"), hit["name"].alias("name"))


@query(
    "empty_results_check",
    "SELECT o_orderkey AS id FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 4 <> 1",
)
def empty_results_check(spark, sf):
    searches = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id",
        "case o_orderkey % 4 when 0 then 'Classic' when 1 then 'news' when 2 then '' else null end as search_type",
        "case o_custkey % 3 when 0 then '{\"organic_results\": [ ]}' when 1 then '{\"organic_results\": [{\"a\": 1}]}' else '[]' end as body",
    )
    return search.empty_results(searches, "body", "search_type").select("id")


@query(
    "compare_rankings",
    """WITH r AS (SELECT n_name, c_name, row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) AS position
        FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT position, max(CASE WHEN n_name = 'NATION_1' THEN c_name END) AS "NATION_1", max(CASE WHEN n_name = 'NATION_2' THEN c_name END) AS "NATION_2",
           max(CASE WHEN n_name = 'NATION_3' THEN c_name END) AS "NATION_3" FROM r WHERE position <= 3 GROUP BY position""",
)
def compare_rankings(spark, sf):
    ranked = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    wanted = ["NATION_1", "NATION_2", "NATION_3"]
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    return search.compare_rankings(ranked, "n_name", wanted, order, "c_name", 3)


@query(
    "chain_keys",
    """SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",
)
def chain_keys(spark, sf):
    found = table(spark, sf, "lineitem").selectExpr("l_partkey", "l_orderkey * 10 + l_linenumber as at")
    return search.chain_keys(found, "l_partkey", "at", table(spark, sf, "part"), "p_partkey").select("p_partkey", "p_name")


@query(
    "chain_extracted_keys",
    """SELECT o.o_orderkey AS id, c.c_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
)
def chain_extracted_keys(spark, sf):
    key = path("customer", "key")
    found = extract_values(order_trees(spark, sf, key), key, "id")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("value"), "c_name")
    return found.join(customers, "value").select("id", "c_name")


@query(
    "map_payload",
    """SELECT page_id, CASE WHEN contains(html, '<html lang="fr">') THEN md5(html)
        ELSE md5(regexp_extract(html, '<title>([^<]*)</title>', 1)) END AS body_md5 FROM pages""",
)
def transform_payloads(spark, sf):
    pages = table(spark, sf, "pages").selectExpr("page_id", "url is not null as good", "cast(html as binary) as body")

    def title(body: bytes) -> bytes:
        if b'<html lang="fr">' in body:
            raise ValueError("not for this language")  # a failed payload stays as it is
        return re.search(rb"<title>(.*?)</title>", body, re.I)[1]

    changed = map_payload(pages, "body", title, ok="good")
    return changed.select("page_id", F.md5("body").alias("body_md5"))
