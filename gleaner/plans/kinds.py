"""Content typing (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import kinds
from ..functions.formats import format_of
from ..operators.rows import spread_small
from ..operators.shape import write_payloads
from .base import query, scratch, table

# Bodies of known kind made out of every page, and their kinds.
_BODIES = """case page_id % 8
    when 0 then cast(html as binary)
    when 1 then cast(concat(' \\n{ "html": ', page_id, ', ', html) as binary)
    when 2 then cast(concat('[', page_id, 'th page](', url, ') ', html) as binary)
    when 3 then cast(concat('[read this](', url, ') ', html) as binary)
    when 4 then cast(concat('text ', html) as binary)
    when 5 then concat(unhex('FFD8FFE0'), cast(html as binary))
    when 6 then cast(concat('GIF89a', html) as binary)
    else concat(unhex('0A89504E470D0A1A0A'), cast(html as binary)) end as body"""
_BODY_KIND = """CASE page_id % 8 WHEN 0 THEN 'html' WHEN 1 THEN 'json' WHEN 2 THEN 'json' WHEN 3 THEN 'md'
    WHEN 5 THEN 'jpg' WHEN 6 THEN 'gif' WHEN 7 THEN 'png' END"""

_HEADERS = """case page_id % 5
    when 0 then map('Content-Type', 'text/HTML; charset=utf-8', 'x', 'y')
    when 1 then map('content-type', 'application/ld+json')
    when 2 then map('X-Other', 'text/html')
    when 3 then map('CONTENT-TYPE', ' image/svg+xml ;q=1')
    else map('content-type', 'application/octet-stream') end as headers"""
_HEADER_KIND = "CASE page_id % 5 WHEN 0 THEN 'html' WHEN 1 THEN 'json' WHEN 3 THEN 'svg' ELSE 'bin' END"

_LINKS = """case page_id % 6
    when 0 then url
    when 1 then concat(substring_index(substring_index(url, '?', 1), '#', 1), '/report.PDF?x=1')
    when 2 then concat(substring_index(substring_index(url, '?', 1), '#', 1), '/a.b/archive.tar.zip/')
    when 3 then concat(substring_index(substring_index(url, '?', 1), '#', 1), '/noext')
    when 4 then concat(substring_index(substring_index(url, '?', 1), '#', 1), '/file.exe')
    else concat('https://host.example.com/x.json;v=1#top') end as link"""
_LINK_KIND = """CASE page_id % 6 WHEN 0 THEN CASE WHEN regexp_matches(url, '[.]html([?#]|$)') THEN 'html' END
    WHEN 1 THEN 'pdf' WHEN 2 THEN 'zip' WHEN 5 THEN 'json' END"""
_FORCED = "if(page_id % 7 = 0, 'txt', cast(null as string)) as forced"
_RESOLVED = f"""coalesce(CASE WHEN page_id % 7 = 0 THEN 'txt' END, {_LINK_KIND}, {_BODY_KIND}, {_HEADER_KIND})"""


def _pages(spark, sf):
    return table(spark, sf, "pages").selectExpr("page_id", _BODIES, _HEADERS, _LINKS, _FORCED)


@query("sniff_body_kind", f"SELECT page_id, {_BODY_KIND} AS kind FROM pages")
def sniff_body_kind(spark, sf):
    return _pages(spark, sf).select("page_id", kinds.sniff_kind(F.col("body")).alias("kind"))


@query("kind_from_content_type", f"SELECT page_id, {_HEADER_KIND} AS kind FROM pages")
def kind_from_content_type(spark, sf):
    return _pages(spark, sf).select("page_id", kinds.kind_from_content_type(F.col("headers")).alias("kind"))


@query("kind_from_url_path", f"SELECT page_id, {_LINK_KIND} AS kind FROM pages")
def kind_from_url_path(spark, sf):
    return _pages(spark, sf).select("page_id", kinds.kind_from_url_path(F.col("link")).alias("kind"))


def _resolved(spark, sf):
    kind = kinds.resolve_kind(F.col("forced"), F.col("link"), F.col("body"), F.col("headers"))
    return _pages(spark, sf).select("page_id", "body", kind.alias("kind"))


@query("resolve_kind", f"SELECT page_id, {_RESOLVED} AS kind FROM pages")
def resolve_kind(spark, sf):
    return _resolved(spark, sf).select("page_id", "kind")


@query(
    "route_kind",
    f"""WITH k AS (SELECT page_id, {_RESOLVED} AS kind FROM pages)
    SELECT page_id, CASE WHEN kind IN ('png', 'jpg', 'gif', 'webp') THEN 'screenshots'
                         WHEN kind IN ('pdf', 'zip') THEN 'files' ELSE 'root' END AS route FROM k""",
)
def route_kind(spark, sf):
    path = scratch(spark, "routes")
    write_payloads(_resolved(spark, sf), "body", "kind", path)
    return spark.read.parquet(path).select("page_id", "route")


@query(
    "is_text_payload",
    "SELECT doc_id, CAST(doc_id % 6 IN (0, 3, 5) AS BOOLEAN) AS is_text FROM documents",
)
def is_text_payload(spark, sf):
    bodies = table(spark, sf, "documents").selectExpr(
        "doc_id",
        """case doc_id % 6
             when 0 then cast(text as binary)
             when 1 then concat(cast(concat('x', 'y') as binary), unhex('00'), cast(text as binary))
             when 2 then cast(concat('%PDF-1.4 ', text) as binary)
             when 3 then concat(cast('{' as binary), unhex('0001'), cast(text as binary))
             when 4 then concat(unhex(repeat('01', 200)), cast(text as binary))
             else concat(unhex(repeat('01', 20)), cast(lpad(text, 400, 'z') as binary)) end as body""",
    )
    return bodies.select("doc_id", kinds.is_text_payload(F.col("body")).alias("is_text"))


# A prose document is taken for CSV if its first line has two or more short cells and its
# first data row has no more cells than that.
_FORMAT_SQL = """
WITH d AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '{"id": ' || doc_id || ', "text": ' || to_json(text) || '}'
                WHEN 1 THEN '{"id": 1}' || chr(10) || chr(10) || ' {"id": ' || doc_id || ', "text": ' || to_json(text) || '}'
                WHEN 2 THEN '# Part ' || doc_id || chr(10) || replace(text, ',', ';')
                WHEN 3 THEN 'name,age' || chr(10) || '"' || replace(text, '"', '""') || '",3'
                ELSE text END AS body FROM documents),
l AS (SELECT doc_id, body, str_split_regex(body, '\r\n|\r|\n') AS lines FROM d),
c AS (SELECT doc_id, body, str_split(lines[1], ',') AS head,
             str_split(list_filter(lines[2:], lambda x: x <> '')[1], ',') AS first_row FROM l)
SELECT doc_id, CASE WHEN trim(body, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN NULL
    WHEN doc_id % 6 = 0 THEN 'json' WHEN doc_id % 6 = 1 THEN 'ndjson' WHEN doc_id % 6 = 3 THEN 'csv'
    WHEN contains(body, ',') AND contains(body, chr(10)) AND len(list_distinct(head)) >= 2 AND first_row IS NOT NULL
         AND len(first_row) <= len(head) AND list_max(list_transform(head, lambda x: length(x))) <= 60 THEN 'csv'
    WHEN doc_id % 6 = 2 THEN 'markdown' ELSE 'text' END AS format FROM c
UNION ALL SELECT 10000000 + page_id, CASE page_id % 3 WHEN 0 THEN 'html' WHEN 1 THEN 'xml' ELSE 'html' END FROM pages
"""


@query("detect_format", _FORMAT_SQL)
def detect_formats(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id",
        """case doc_id % 6
             when 0 then to_json(named_struct('id', doc_id, 'text', text))
             when 1 then concat('{"id": 1}\\n\\n ', to_json(named_struct('id', doc_id, 'text', text)))
             when 2 then concat('# Part ', doc_id, '\\n', replace(text, ',', ';'))
             when 3 then concat('name,age\\n"', replace(text, '"', '""'), '",3')
             else text end as body""",
    )
    pages = table(spark, sf, "pages").selectExpr(
        "10000000 + page_id as doc_id",
        """case page_id % 3 when 0 then html
             when 1 then concat('<?xml version="1.0"?><page id="', page_id, '"><title>', replace(replace(html, '&', '&amp;'), '<', '&lt;'), '</title></page>')
             else concat('<?xml version="1.0"?><page id="', page_id, '"><title>broken</page>', html) end as body""",
    )
    rows = spread_small(docs.unionByName(pages))
    return rows.select("doc_id", format_of(F.col("body")).alias("format"))


_PARAMS = """map('screenshot', if(o_orderkey & 1 = 1, 'true', 'false'), 'json_response', if(o_orderkey & 2 = 2, 'YES', ''),
    'return_page_markdown', if(o_orderkey & 4 = 4, '1', '0'), 'return_page_text', if(o_orderkey & 8 = 8, 'true', 'off'),
    'ai_query', if(o_orderkey & 16 = 16, 'price', ''), 'wait', '5') as params"""


@query(
    "kind_from_request_params",
    """SELECT o_orderkey, CASE WHEN o_orderkey & 1 = 1 AND o_orderkey & 2 = 2 THEN 'json' WHEN o_orderkey & 1 = 1 THEN 'png'
       WHEN o_orderkey & 4 = 4 THEN 'md' WHEN o_orderkey & 8 = 8 THEN 'txt'
       WHEN o_orderkey & 2 = 2 OR o_orderkey & 16 = 16 THEN 'json' END AS kind FROM orders""",
)
def kind_from_request_params(spark, sf):
    requests = table(spark, sf, "orders").selectExpr("o_orderkey", _PARAMS)
    return requests.select("o_orderkey", kinds.kind_from_request(F.col("params")).alias("kind"))


@query(
    "decode_embedded_binary",
    "SELECT doc_id, md5(text) AS md5, CAST(length(text) + 2 AS INTEGER) AS n_chars FROM documents",
)
def decode_embedded_binary(spark, sf):
    wrapped = table(spark, sf, "documents").selectExpr(
        "doc_id", "to_json(named_struct('screenshot', replace(base64(cast(text as binary)), '\\r\\n', ''), 'body', concat('<', text, '>'))) as body"
    )
    return wrapped.select(
        "doc_id",
        F.md5(kinds.embedded_binary(F.col("body"))).alias("md5"),
        kinds.embedded_length(F.col("body")).alias("n_chars"),
    )
