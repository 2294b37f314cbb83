"""Link graph (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crawl, links
from .base import query, table

_HREF = r"""<a\s+[^>]*href\s*=\s*["'']([^"'']+)["'']"""
_LINKS_SQL = rf"""
l0 AS (SELECT page_id, url AS page_url, regexp_extract_all(html, '(?i){_HREF}', 1) AS hrefs FROM pages),
l AS (SELECT page_id, page_url, CAST(unnest(range(len(hrefs))) AS INTEGER) AS ord, trim(replace(unnest(hrefs), '&amp;', '&')) AS href FROM l0)
"""


@query("extract_links_html", f"WITH {_LINKS_SQL} SELECT page_id, ord, href FROM l")
def extract_links_html(spark, sf):
    return links.extract_links(table(spark, sf, "pages"), links.html_links(F.col("html")), "page_id")


# every page with links in the forms that a browser knows: the added part, and what it must give
_FORMS = """concat(html, '<!-- <a href="/hidden">x</a> --><a href=/bare/', page_id, '>u</a><A class=c HREF=''/single?a=1&amp;b=2''>s</A>',
                  '<a href="&#x2F;hex&#47;dec&eacute;&euro;&notanentity;&amp;lt;">e</a><a title="a > b" href="">n</a><a name="href=no">q</a>')"""
_FORM_HREFS = "['/bare/' || page_id, '/single?a=1&b=2', '/hex/decé€&notanentity;&lt;']"


@query(
    "extract_links_forms",
    f"""WITH {_LINKS_SQL}, n AS (SELECT page_id, count(href) AS n FROM pages LEFT JOIN l USING (page_id) GROUP BY 1)
    SELECT page_id, ord, href FROM l
    UNION ALL SELECT page_id, CAST(n + unnest(range(3)) AS INTEGER), unnest({_FORM_HREFS}) FROM n""",
)
def extract_links_forms(spark, sf):
    forms = table(spark, sf, "pages").selectExpr("page_id", f"{_FORMS} as body")
    return links.extract_links(forms, links.page_links(F.col("body")), "page_id")


@query(
    "resolve_links_base",
    """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://base.example.com/dir/x' || page_id
                WHEN 1 THEN regexp_extract(url, '^https?://[^/?#]*', 0) || '/other/x' || page_id
                ELSE regexp_extract(url, '^https?://[^/?#]*[^?#]*/', 0) || 'x' || page_id END AS url FROM pages""",
)
def resolve_links_base(spark, sf):
    pages = table(spark, sf, "pages").selectExpr(
        "page_id", "url",
        """concat(case page_id % 3 when 0 then '<base target="_top" href="https://base.example.com/dir/page">'
                  when 1 then '<BASE href=/other/>' else '' end, '<a href="x', page_id, '">x</a>') as body""",
    )
    found = links.extract_links(
        pages.withColumn("from", links.base_href(F.col("body"), F.col("url"))), links.page_links(F.col("body")), "page_id", "from"
    )
    return links.resolve_links(found, "from").select("page_id", "url")


@query(
    "extract_links_markdown",
    """SELECT doc_id, CAST(0 AS INTEGER) AS ord, '/doc/' || doc_id AS href FROM documents WHERE doc_id % 3 <> 0
       UNION ALL SELECT doc_id, 1, 'https://x.com/' || lang FROM documents WHERE doc_id % 3 <> 0
       UNION ALL SELECT doc_id, 0, '/html' FROM documents WHERE doc_id % 3 = 0""",
)
def extract_links_markdown(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id",
        """concat('[one](/doc/', doc_id, ') [mail](mailto:a@b.c) [top](#top) ', text, ' [two]( https://x.com/', lang, ' )',
                  if(doc_id % 3 = 0, '<A class="x" HREF="/html">z</a>', '')) as body""",
    )
    return links.extract_links(docs, links.page_links(F.col("body")), "doc_id")


@query(
    "extract_links_envelope",
    f"""WITH {_LINKS_SQL}
    SELECT page_id, ord, href FROM l WHERE page_id % 4 <> 3
    UNION ALL SELECT page_id, CAST(0 AS INTEGER), '/md?a=1&amp;b=' || page_id FROM pages WHERE page_id % 4 = 3""",
)
def extract_links_envelope(spark, sf):
    wrapped = table(spark, sf, "pages").selectExpr(
        "page_id",
        """case page_id % 4 when 0 then html
             when 1 then to_json(named_struct('body', html, 'content', 'x'))
             when 2 then to_json(named_struct('body', '', 'content', html))
             else to_json(named_struct('body', concat('see [md](/md?a=1&amp;b=', page_id, ')'))) end as body""",
    )
    return links.extract_links(wrapped, links.page_links(F.col("body")), "page_id")


def _resolved(spark, sf):
    found = links.extract_links(table(spark, sf, "pages"), links.html_links(F.col("html")), "page_id", "url")
    return links.resolve_links(found.withColumnRenamed("url", "page_url"), "page_url")


@query(
    "resolve_links",
    rf"""WITH {_LINKS_SQL}, u AS (SELECT DISTINCT page_id, page_url FROM l),
    x AS (SELECT page_id, page_url, regexp_extract(page_url, '^(https?)://', 1) AS s, regexp_extract(page_url, '^https?://[^/?#]*', 0) AS origin,
                 regexp_extract(page_url, '^https?://[^/?#]*([^?#]*/)', 1) AS folder, regexp_extract(page_url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM u)
    SELECT page_id, ord, regexp_extract(page_url, '^https?://[^/?#]*', 0) || href AS url FROM l
    UNION ALL SELECT page_id, 1000, origin || folder || 'next.html?x=1#y' FROM x
    UNION ALL SELECT page_id, 1001, s || '://cdn.example.com/lib/./a/../b' FROM x
    UNION ALL SELECT page_id, 1002, origin || path || '?q=1' FROM x
    UNION ALL SELECT page_id, 1003, origin || '/up/c' FROM x
    UNION ALL SELECT page_id, 1004, 'ftp://files.example.com/x' FROM x
    UNION ALL SELECT page_id, 1005, origin || '/a/' FROM x""",
)
def resolve_links(spark, sf):
    found = links.extract_links(table(spark, sf, "pages"), links.html_links(F.col("html")), "page_id", "url")
    page = found.select("page_id", "url").distinct()
    extra = page.select(
        "page_id", "url",
        F.posexplode(F.array(*[F.lit(h) for h in (
            "next.html?x=1#y", "//cdn.example.com/lib/./a/../b", "?q=1", "/up/./b/../c", "ftp://files.example.com/x", "/a/b/..", "mailto:a@b.c",
        )])).alias("ord", "href"),
    ).withColumn("ord", F.col("ord") + 1000)
    both = found.unionByName(extra).withColumnRenamed("url", "page_url")
    return links.resolve_links(both, "page_url").select("page_id", "ord", "url")


@query(
    "filter_links",
    rf"""WITH {_LINKS_SQL}, f AS (SELECT page_id, ord, regexp_extract(page_url, '^https?://[^/?#]*', 0) || href AS url,
        lower(regexp_extract(page_url, '^https?://([^/?#]*)', 1)) AS host FROM l)
    SELECT page_id, ord, url FROM f WHERE regexp_matches(replace(url, '//', ''), '/[\x20-\x7E]*$') AND NOT regexp_matches(regexp_extract(url, '^https?://[^/?#]*(.*)', 1), '[^\x20-\x7E]')
      AND host IN (SELECT lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) FROM pages WHERE page_id % 2 = 0)
      AND regexp_matches(url, '/[a-z]') AND NOT regexp_matches(url, '/th')""",
)
def filter_links(spark, sf):
    seeds = table(spark, sf, "pages").filter("page_id % 2 = 0")
    hosts = seeds.select(links.url_host(F.col("url")).alias("host"))
    kept = links.filter_links(_resolved(spark, sf), hosts=hosts, include="/[a-z]", exclude="/th")
    return kept.select("page_id", "ord", "url")


# Parts and suppliers as pages that link to each other: a graph full of cycles.
_PART, _SUPP = "https://shop.example.com/part/", "https://shop.example.com/supplier/"


def _graph(spark, sf):
    lines = table(spark, sf, "lineitem")
    to_supp = lines.selectExpr(
        f"concat('{_PART}', l_partkey, '/') as src_url", "l_linenumber as ord", f"concat('{_SUPP}', l_suppkey, '#top') as dst_url"
    )
    to_part = lines.selectExpr(
        f"concat('{_SUPP}', l_suppkey) as src_url", "l_partkey as ord", f"concat('{_PART}', l_partkey, '/index.html') as dst_url"
    )
    return to_supp.unionByName(to_part)


def _seeds(spark, sf):
    return table(spark, sf, "part").filter("p_size = 11").selectExpr(f"concat('{_PART}', p_partkey) as url")


_CRAWL_SQL = f"""
e AS (SELECT '{_PART}' || l_partkey AS src, '{_SUPP}' || l_suppkey AS dst, min(l_linenumber) AS ord FROM lineitem GROUP BY 1, 2
      UNION ALL SELECT '{_SUPP}' || l_suppkey, '{_PART}' || l_partkey, min(l_partkey) FROM lineitem GROUP BY 1, 2),
walk AS (SELECT '{_PART}' || p_partkey AS key, 0 AS depth FROM part WHERE p_size = 11
         UNION SELECT e.dst, walk.depth + 1 FROM walk JOIN e ON e.src = walk.key WHERE walk.depth < {{depth}}),
visited AS (SELECT key, min(depth) AS depth FROM walk GROUP BY key)
"""


# walked to its end; the oracle needs some bound, far beyond any distance in the graph
@query("crawl_frontier", f"WITH RECURSIVE {_CRAWL_SQL.format(depth=16)} SELECT key, CAST(depth AS INTEGER) AS depth FROM visited")
def crawl_frontier(spark, sf):
    return crawl.crawl_frontier(_graph(spark, sf), _seeds(spark, sf)).select("key", "depth")


@query(
    "save_filter",
    f"WITH RECURSIVE {_CRAWL_SQL.format(depth=16)} SELECT key, CAST(depth AS INTEGER) AS depth FROM visited WHERE regexp_matches(key, '/part/[0-9]*7$')",
)
def save_filter(spark, sf):
    visited = crawl.crawl_frontier(_graph(spark, sf), _seeds(spark, sf))
    return crawl.save_filter(visited, r"/part/[0-9]*7$", "key").select("key", "depth")


# Discovery order: by the parent's rank, then the link's ordinal, then the address; more levels than the walk has.
_LEVELS = 12
_RANKED_SQL = f"""
v0 AS (SELECT '{_PART}' || p_partkey AS key, row_number() OVER (ORDER BY '{_PART}' || p_partkey) - 1 AS rank FROM part WHERE p_size = 11),
""" + "".join(
    f"""c{n} AS (SELECT e.dst AS key, min((v{n - 1}.rank, e.ord)) AS first FROM v{n - 1} JOIN e ON e.src = v{n - 1}.key
       WHERE {" AND ".join(f"e.dst NOT IN (SELECT key FROM v{m})" for m in range(n))} GROUP BY 1),
v{n} AS MATERIALIZED (SELECT key, row_number() OVER (ORDER BY first, key) - 1 AS rank FROM c{n}),
"""
    for n in range(1, _LEVELS)
) + "ranked AS (" + " UNION ALL ".join(f"SELECT key, {n} AS depth, rank FROM v{n}" for n in range(_LEVELS)) + ")"
_EDGES_SQL = _CRAWL_SQL.split("walk AS")[0].rstrip().rstrip(",")


@query(
    "cap_pages",
    f"""WITH {_EDGES_SQL}, {_RANKED_SQL} SELECT key, CAST(depth AS INTEGER) AS depth FROM ranked
    WHERE NOT regexp_matches(key, '3$') ORDER BY ranked.depth, rank LIMIT 40""",
)
def cap_pages(spark, sf):
    visited = crawl.crawl_frontier(_graph(spark, sf), _seeds(spark, sf), ranked=True)
    return crawl.cap_pages(visited, 40, ok=~F.col("key").rlike("3$")).select("key", "depth")


def _manifest(spark, sf):
    return table(spark, sf, "supplier").filter("s_suppkey % 3 = 0").selectExpr(f"concat('{_SUPP}', s_suppkey, '/') as input")


@query(
    "resume_crawl",
    f"""WITH {_EDGES_SQL}, {_RANKED_SQL}, done AS (SELECT '{_SUPP}' || s_suppkey AS key FROM supplier WHERE s_suppkey % 3 = 0)
    SELECT key, (SELECT count(*) FROM done) + row_number() OVER (ORDER BY depth, rank) AS n FROM ranked WHERE key NOT IN (SELECT key FROM done)""",
)
def resume_crawl(spark, sf):
    visited = crawl.crawl_frontier(_graph(spark, sf), _seeds(spark, sf), ranked=True)
    return crawl.resume_crawl(visited, _manifest(spark, sf)).select("key", "n")


@query(
    "merge_manifests",
    f"""SELECT '{_SUPP}' || s_suppkey || '/' AS input, CASE WHEN s_suppkey % 2 = 0 THEN 'new/' ELSE 'old/' END || s_suppkey AS file
        FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0""",
)
def merge_manifests(spark, sf):
    entries = lambda folder, n: table(spark, sf, "supplier").filter(f"s_suppkey % {n} = 0").selectExpr(
        f"concat('{_SUPP}', s_suppkey, '/') as input", f"concat('{folder}/', s_suppkey) as file"
    )
    return crawl.merge_manifests(entries("old", 3), entries("new", 2))


@query(
    "discovery_request_plan",
    """WITH q AS (SELECT o_orderkey, (o_orderkey & 1 = 1 AND o_orderkey & 2 = 0) OR o_orderkey & 4 = 4 OR o_orderkey & 8 = 8 AS two,
        (o_orderkey & 1 = 1) AS shot FROM orders)
    SELECT o_orderkey, 'fetch' AS step, CAST(5 AS INTEGER) AS n_params FROM q WHERE NOT two
    UNION ALL SELECT o_orderkey, 'discovery', 1 FROM q WHERE two UNION ALL SELECT o_orderkey, 'save', 5 FROM q WHERE two""",
)
def discovery_request_plan(spark, sf):
    requests = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """map('screenshot', if(o_orderkey & 1 = 1, 'true', 'false'), 'json_response', if(o_orderkey & 2 = 2, 'true', ''),
               'return_page_text', if(o_orderkey & 4 = 4, '1', ''), 'ai_query', if(o_orderkey & 8 = 8, 'price', ''), 'wait', '500') as params""",
    )
    plan = crawl.discovery_request_plan(requests)
    return plan.select("o_orderkey", "step", F.size("params").alias("n_params"))


@query(
    "contact_links",
    rf"""WITH {_LINKS_SQL}, n AS (SELECT page_id, count(*) AS n FROM l GROUP BY page_id)
    SELECT p.page_id, 'mailto:shop' || p.page_id || '@example.com' AS emails, CASE WHEN p.page_id % 2 = 0 THEN 'tel:+1' || p.page_id ELSE '' END AS phones,
           coalesce(n.n, 0) + 1 + CASE WHEN p.page_id % 2 = 0 THEN 1 ELSE 0 END AS n_links FROM pages p LEFT JOIN n ON n.page_id = p.page_id""",
)
def contact_links(spark, sf):
    pages = table(spark, sf, "pages").selectExpr(
        "page_id",
        """concat(html, '<a href="mailto:shop', page_id, '@example.com">mail</a>', if(page_id % 2 = 0, concat('<a href="tel:+1', page_id, '">call</a>'), '')) as body""",
    )
    found = links.contact_links(pages, "body", "page_id")
    return found.select(
        "page_id", F.array_join("emails", " ").alias("emails"), F.array_join("phones", " ").alias("phones"),
        F.size("links").cast("long").alias("n_links"),
    )


@query(
    "site_link_graph",
    rf"""WITH {_LINKS_SQL}, f AS (SELECT page_url AS src, regexp_extract(page_url, '^https?://[^/?#]*', 0) || href AS dst FROM l),
    k AS (SELECT * FROM f WHERE NOT regexp_matches(regexp_extract(dst, '^https?://[^/?#]*(.*)', 1), '[^\x20-\x7E]')),
    e AS (SELECT lower(regexp_extract(src, '^https?://([^/?#]*)', 1)) AS host, dst AS o, NULL AS i FROM k
          UNION ALL SELECT lower(regexp_extract(dst, '^https?://([^/?#]*)', 1)), NULL, src FROM k)
    SELECT host, count(o) AS links_out, count(i) AS links_in, count(DISTINCT o) AS pages_out, count(DISTINCT i) AS pages_in FROM e GROUP BY host""",
)
def site_link_graph(spark, sf):
    return links.site_link_graph(links.filter_links(_resolved(spark, sf)), "page_url", "url")
