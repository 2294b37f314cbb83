"""Sources (A) and input preparation (B)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import inputs
from ..operators.shape import write_csv
from ..sources import files, sitemaps
from .base import query, scratch, table


def _pages(spark, sf):
    return table(spark, sf, "pages")


@query(
    "read_input_lines",
    """
    WITH v AS (SELECT page_id * 2 AS "at", CASE WHEN page_id % 3 = 0 THEN '  ' || url || chr(9) ELSE url END AS value FROM pages
               UNION ALL SELECT page_id * 2 + 1, '   ' FROM pages WHERE page_id % 4 = 0)
    SELECT CAST(row_number() OVER (ORDER BY "at") - 1 AS BIGINT) AS index, trim(value, ' ' || chr(9)) AS input
    FROM v WHERE trim(value, ' ' || chr(9)) <> ''
    """,
)
def read_input_lines(spark, sf):
    pages = _pages(spark, sf)
    lines = pages.selectExpr("page_id * 2 as at", "if(page_id % 3 = 0, concat('  ', url, '\\t'), url) as value")
    blanks = pages.filter("page_id % 4 = 0").selectExpr("page_id * 2 + 1 as at", "'   ' as value")
    path = scratch(spark, "input-lines")
    # several files, whose names follow the order of the lines
    lines.unionByName(blanks).repartitionByRange(4, "at").sortWithinPartitions("at").select("value").write.text(path)
    return files.read_input_lines(spark, path)


@query(
    "read_input_column",
    """SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS index, 'Customer ' || c_custkey || ', "' || c_mktsegment || '"' AS input
       FROM customer WHERE c_custkey % 9 <> 0""",
)
def read_input_column(spark, sf):
    # files to read, in the order of their names: written to the shared checkpoint folder, never to a machine's own disk
    path = scratch(spark, "input-column")
    cells = table(spark, sf, "customer").selectExpr(
        "c_custkey as code",
        "if(c_custkey % 9 = 0, '  ', concat(' Customer ', c_custkey, ', \"', c_mktsegment, '\"')) as company",
    )
    write_csv(cells, path, order=["code"])
    return files.read_input_column(spark, path, "company").select("index", "input")


@query(
    "read_payload_dir",
    """
    SELECT doc_id AS n, CASE WHEN doc_id % 3 = 0 THEN 'screenshots/' ELSE '' END || doc_id ||
           CASE doc_id % 4 WHEN 0 THEN '.json' WHEN 1 THEN '.html' ELSE '.txt' END AS file,
           CASE doc_id % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'html' ELSE 'txt' END AS ext, md5(text) AS body_md5
    FROM documents WHERE doc_id % 4 <> 2 AND doc_id % 10 <> 7
    """,
)
def read_payload_dir(spark, sf):
    # every document becomes a payload file below the shared checkpoint folder
    named = table(spark, sf, "documents").selectExpr(
        """concat(if(doc_id % 3 = 0, 'screenshots/', ''), if(doc_id % 10 = 7, 'note-', ''), doc_id,
                  case doc_id % 4 when 0 then '.json' when 1 then '.html' when 2 then '.err' else '.txt' end) as file""",
        "cast(text as binary) as body",
    )
    folder = scratch(spark, "payloads")
    files.write_payload_files(named, "file", "body", folder)
    return files.read_payload_dir(spark, folder).select("n", "file", "ext", F.md5("body").alias("body_md5"))


@query(
    "read_manifest",
    """
    SELECT 'https://a.com/' || c_custkey AS input, c_custkey || '.json' AS file, CAST(NULL AS INTEGER) AS http_status FROM customer
    UNION ALL
    SELECT 'https://b.com/' || c_custkey, 'files/' || c_custkey || '.pdf', 200 + c_nationkey FROM customer
    """,
)
def read_manifest(spark, sf):
    entries = table(spark, sf, "customer").selectExpr(
        "c_custkey div 50 as part",
        """array(named_struct('key', concat('https://a.com/', c_custkey), 'value', concat('"', c_custkey, '.json"')),
                 named_struct('key', concat('https://b.com/', c_custkey), 'value',
                        concat('{"file": "files/', c_custkey, '.pdf", "http_status": ', 200 + c_nationkey, '}'))) as pair""",
    )
    # one manifest file per fifty customers
    manifests = entries.groupBy("part").agg(F.flatten(F.collect_list("pair")).alias("pairs")).selectExpr(
        "part", """concat('{', array_join(transform(pairs, p -> concat('"', p.key, '": ', p.value)), ', '), '}') as value"""
    )
    path = scratch(spark, "manifests")
    manifests.write.partitionBy("part").text(path)
    return files.read_manifest(spark, path).select("input", "file", "http_status")


def _sitemap_pages(spark, sf):
    """One sitemap per page: namespaced for even pages, bare for odd ones, some malformed."""
    return _pages(spark, sf).selectExpr(
        "page_id",
        "concat('https://maps.example.com/page/', page_id) as url",
        """concat('<?xml version="1.0"?><urlset', if(page_id % 2 = 0, ' xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"', ''),
                  '><url><loc> ', replace(url, '&', '&amp;'), ' </loc></url>',
                  if(page_id % 3 = 0, concat('<url><loc>https://more.example.com/', page_id, '</loc><priority>1</priority></url><url><loc> </loc></url>'), ''),
                  if(page_id % 11 = 5, '</broken>', '</urlset>')) as body""",
    )


@query(
    "sitemap_urls",
    """
    SELECT 'https://maps.example.com/page/' || page_id AS url, CAST(0 AS INTEGER) AS ord, url AS page_url FROM pages WHERE page_id % 11 <> 5
    UNION ALL
    SELECT 'https://maps.example.com/page/' || page_id, 1, 'https://more.example.com/' || page_id
    FROM pages WHERE page_id % 3 = 0 AND page_id % 11 <> 5
    """,
)
def sitemap_urls(spark, sf):
    return sitemaps.sitemap_urls(_sitemap_pages(spark, sf), "url", "body")


@query(
    "sitemap_index_expand",
    """
    WITH links AS (SELECT page_id AS p, page_id AS child FROM pages UNION ALL SELECT page_id, page_id + 1 FROM pages),
    u AS (SELECT page_id, url FROM pages WHERE page_id % 11 <> 5
          UNION ALL SELECT page_id, 'https://more.example.com/' || page_id FROM pages WHERE page_id % 3 = 0 AND page_id % 11 <> 5)
    SELECT 'https://maps.example.com/super/' || p AS seed, CAST(2 AS INTEGER) AS depth, u.url AS page_url
    FROM links JOIN u ON u.page_id = links.child
    """,
)
def sitemap_index_expand(spark, sf):
    pages = _pages(spark, sf)
    index = lambda name, kids: pages.selectExpr(
        f"concat('https://maps.example.com/{name}/', page_id) as url",
        f"concat('<sitemapindex xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\">', {kids}, '</sitemapindex>') as body",
    )
    loc = lambda name, n: f"'<sitemap><loc>https://maps.example.com/{name}/', {n}, '</loc></sitemap>'"
    stored = (
        _sitemap_pages(spark, sf).select("url", "body")
        .unionByName(index("index", f"concat({loc('page', 'page_id')}, {loc('page', 'page_id + 1')})"))
        .unionByName(index("super", f"concat({loc('index', 'page_id')})"))
    )
    seeds = pages.selectExpr("concat('https://maps.example.com/super/', page_id) as url")
    return sitemaps.sitemap_index_expand(stored, seeds)


_AUDIT_LINE = """concat(if(event_id % 13 = 0, 'broken', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), if(event_id % 13 = 0, '', '+00:00'),
                 ' | post-process | ', event_type, ' | ', user_id, ' | ') as line"""


@query(
    "read_audit_log",
    """
    SELECT 'post-process' AS feature, event_type AS command, CAST(user_id AS VARCHAR) AS input, '' AS output_dir
    FROM events WHERE event_id % 13 <> 0 AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
    """,
)
def read_audit_log(spark, sf):
    path = scratch(spark, "audit")
    lines = table(spark, sf, "events").selectExpr("event_id as at", _AUDIT_LINE)
    lines.repartitionByRange(3, "at").sortWithinPartitions("at").select("line").write.text(path)
    utc = dt.timezone.utc
    found = files.read_audit_log(
        spark, path, since=dt.datetime(2024, 1, 5, tzinfo=utc), until=dt.datetime(2024, 1, 20, 12, tzinfo=utc)
    )
    return found.select(*files.AUDIT_COLUMNS)


@query(
    "audit_log_tail",
    """SELECT event_type AS command, CAST(user_id AS VARCHAR) AS input FROM events ORDER BY event_id DESC LIMIT 500""",
)
def audit_log_tail(spark, sf):
    path = scratch(spark, "audit-tail")
    lines = table(spark, sf, "events").selectExpr("event_id as at", _AUDIT_LINE)
    lines.repartitionByRange(5, "at").sortWithinPartitions("at").select("line").write.text(path)
    return files.read_audit_log(spark, path, n=500).select("command", "input")


@query("retain_last_n", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 500")
def retain_last_n(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return files.retain_last_n(events, "ts", "event_id", n=500).select("event_id", "event_type")


@query(
    "quota_from_usage",
    """
    SELECT c_custkey,
           CAST(CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey > c_nationkey * 20 THEN c_custkey - c_nationkey * 20 ELSE 7 END
                     WHEN c_custkey % 3 = 1 THEN c_nationkey ELSE 0 END AS BIGINT) AS credits,
           CAST(CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_nationkey BETWEEN 1 AND 24 AND c_nationkey <> 5 THEN c_nationkey ELSE 5 END
                     WHEN c_custkey % 3 = 1 THEN 12 ELSE 5 END AS INTEGER) AS max_concurrency
    FROM customer
    """,
)
def quota_from_usage(spark, sf):
    reports = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        """case c_custkey % 3
             when 0 then concat('{"max_api_credit": ', c_custkey, ', "used_api_credit": ', c_nationkey * 20,
                                ', "max_concurrency": ', c_nationkey, ', "balance": 7}')
             when 1 then concat('{"available_credits": ', c_nationkey, ', "max_concurrency": 0, "concurrency": 12}')
             else '{"max_api_credit": "many", not json' end as body""",
    )
    return files.quota_from_usage(reports, "body", "c_custkey")


_VARIANTS = """explode(array(url, upper(url), concat(url, '//'), concat('code ', page_id), concat('mailto:Shop@', page_id, '.com'),
               concat(substring_index(url, '?', 1), '/INDEX.html?q=1'), concat(substring_index(url, '?', 1), '/index.htm'))) as input"""
_VARIANTS_SQL = """
v AS (SELECT page_id, unnest([url, upper(url), url || '//', 'code ' || page_id, 'mailto:Shop@' || page_id || '.com',
             split_part(url, '?', 1) || '/INDEX.html?q=1', split_part(url, '?', 1) || '/index.htm']) AS input FROM pages),
f AS (SELECT page_id, input, split_part(input, '#', 1) AS u FROM v),
g AS (SELECT page_id, input, u, lower(regexp_extract(u, '^([A-Za-z]+):', 1)) AS scheme,
             regexp_extract(u, '^[A-Za-z]+://([^/?]*)', 1) AS host,
             regexp_extract(u, '^(?:[A-Za-z]+:)?(?://[^/?]*)?([^?]*)', 1) AS path,
             regexp_extract(u, '[?](.*)$', 1) AS q FROM f)
"""


def _url_variants(spark, sf):
    return _pages(spark, sf).selectExpr("page_id", _VARIANTS)


@query(
    "normalize_url_batch",
    f"""WITH {_VARIANTS_SQL}
    SELECT page_id, input, CASE WHEN scheme = '' THEN input ELSE
        rtrim(scheme || ':' || CASE WHEN host = '' THEN '' ELSE '//' || lower(host) END || path ||
              CASE WHEN q = '' THEN '' ELSE '?' || q END, '/') END AS normalized FROM g""",
)
def normalize_url_batch(spark, sf):
    return _url_variants(spark, sf).withColumn("normalized", urls.normalize_batch_url(F.col("input")))


@query(
    "dedupe_inputs",
    """
    WITH v AS (SELECT page_id * 2 AS index, url AS input FROM pages
               UNION ALL SELECT page_id * 2 + 1, split_part(url, '#', 1) || '/' FROM pages),
    k AS (SELECT *, rtrim(regexp_replace(split_part(input, '#', 1), '^(https?://[^/?]*)', lower(regexp_extract(input, '^(https?://[^/?]*)', 1))), '/') AS key FROM v)
    SELECT index, input FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY index) = 1
    """,
)
def dedupe_inputs(spark, sf):
    pages = _pages(spark, sf)
    rows = pages.selectExpr("page_id * 2 as index", "url as input").unionByName(
        pages.selectExpr("page_id * 2 + 1 as index", "concat(substring_index(url, '#', 1), '/') as input")
    )
    return inputs.dedupe_inputs(rows, "input", "index")


@query(
    "normalize_url_crawl",
    f"""WITH {_VARIANTS_SQL},
    p AS (SELECT *, rtrim(regexp_replace(path, '/index\\.html?$', '/', 'i'), '/') AS t FROM g)
    SELECT page_id, input, scheme || '://' || host || CASE WHEN t = '' THEN '/' ELSE t END ||
           CASE WHEN q = '' THEN '' ELSE '?' || q END AS normalized FROM p""",
)
def normalize_url_crawl(spark, sf):
    return _url_variants(spark, sf).withColumn("normalized", urls.normalize_crawl_url(F.col("input")))


@query(
    "ensure_scheme",
    """WITH v AS (SELECT page_id, unnest([url, regexp_replace(url, '^https?://', ''), 'ftp://x/' || page_id, '']) AS input FROM pages)
    SELECT page_id, input, CASE WHEN input = '' OR regexp_matches(input, '^(https?|ftp)://') THEN input ELSE 'https://' || input END AS url FROM v""",
)
def ensure_scheme(spark, sf):
    rows = _pages(spark, sf).selectExpr(
        "page_id", "explode(array(url, regexp_replace(url, '^https?://', ''), concat('ftp://x/', page_id), '')) as input"
    )
    return rows.withColumn("url", urls.ensure_scheme(F.col("input")))


@query(
    "sample_exact",
    "SELECT doc_id, lang FROM documents ORDER BY md5('7' || chr(31) || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100",
)
def sample_exact(spark, sf):
    return inputs.sample_exact(table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], 100, seed=7)


@query(
    "extract_video_id",
    """
    WITH k AS (SELECT p_partkey, left(md5(CAST(p_partkey AS VARCHAR)), 11) AS vid FROM part)
    SELECT p_partkey, CASE WHEN p_partkey % 6 = 5 THEN 'https://vid.example.com/' || vid ELSE vid END AS video_id FROM k
    """,
)
def extract_video_id(spark, sf):
    parts = table(spark, sf, "part").selectExpr("p_partkey", "left(md5(cast(p_partkey as string)), 11) as vid")
    values = parts.selectExpr(
        "p_partkey",
        """case p_partkey % 6 when 0 then vid when 1 then concat('https://www.youtube.com/watch?v=', vid, '&t=3')
             when 2 then concat('https://youtu.be/', vid) when 3 then concat('https://youtube.com/shorts/', vid)
             when 4 then concat('https://www.youtube.com/embed/', vid) else concat('https://vid.example.com/', vid) end as value""",
    )
    return values.select("p_partkey", urls.video_id(F.col("value")).alias("video_id"))


@query("url_domain_list", "SELECT DISTINCT lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS domain FROM pages")
def url_domain_list(spark, sf):
    return inputs.domain_list(_pages(spark, sf), "url")


@query("keyword_filter", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)tion the|oiment|zueinen')")
def keyword_filter(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return inputs.keyword_filter(docs, "text", ["tion the", "oiment", "zueinen"]).select("doc_id")
