"""Links: extraction, resolution, filtering, per-page and per-host summaries."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import strict_json
from ..functions.text import BYTE_WHITESPACE, decode_lossy, strip
from ..functions.urls import is_plain_ascii_url, join_url, url_host, url_scheme
from .rows import explode_rows

# The link shape inside JSON wrappers, that of Markdown, and links that lead to no page.
WRAPPED_LINK = r"""(?i)<a\s+[^>]*href\s*=\s*["']([^"']+)["']"""
MARKDOWN_LINK = r"\]\s*\(\s*([^)\s]+)\s*\)"
NO_PAGE = ("#", "mailto:", "javascript:")

COMMENT = r"(?s)<!--.*?(?:-->|$)"
# a start tag up to an attribute, past the ones before it, then its value in any of the three quoting forms
ATTRIBUTE = (
    r"""(?is)<{tag}(?=[\s/])(?:[\s/]*+(?!{name}\s*+=)[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+|))?+)*+"""
    r"""[\s/]*+{name}\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
)
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _leads_nowhere(href: Column) -> Column:
    test = F.lit(False)
    for start in NO_PAGE:
        test = test | href.startswith(start)
    return test


def decode_entities(text: Column) -> Column:
    """Character references, numeric ones and the names of HTML 4 and XML, in one pass from left to right."""
    names = {**name2codepoint, "apos": 39}
    named = F.create_map(*[F.lit(x) for name, code in names.items() for x in (name, chr(code))])

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, ENTITY, 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(
            name.startswith("#"), F.substr(name, F.lit(2))
        ).cast("long")
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(
            F.try_element_at(named, name)
        )
        rest = F.substr(part, F.length(name) + 2)
        return F.when((name != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))

    parts = F.split(text, "&", -1)
    whole = F.array_join(F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(decoded(part))), "")
    return F.when(text.contains("&"), whole).otherwise(text)


def attributes(text: Column, tag: str, name: str) -> Column:
    """Values of an attribute of all elements of a name, in order: quoted or not, entities decoded, without
    the surrounding white space; empty ones and those inside comments are left out."""
    shown = F.when(text.contains("<!--"), F.regexp_replace(text, COMMENT, "")).otherwise(text)
    found = F.regexp_extract_all(shown, F.lit(ATTRIBUTE.format(tag=tag, name=name)), F.lit(1))
    bare = F.transform(found, lambda v: strip(decode_entities(F.regexp_replace(v, r"""(?s)^(["'])(.*)\1$""", "$2"))))
    return F.filter(bare, lambda v: v != "")


def html_links(text: Column) -> Column:
    """``href`` values of ``<a>`` elements, in order."""
    return attributes(text, "a", "href")


def wrapped_links(text: Column) -> Column:
    """Quoted ``href`` values of ``<a>`` elements in a text from a JSON wrapper, as they stand."""
    return F.transform(F.regexp_extract_all(text, F.lit(WRAPPED_LINK), F.lit(1)), strip)


def base_href(body: Column, page: Column) -> Column:
    """The URL that a page's links are relative to: its first ``<base href>``, itself relative to
    the page, else the page."""
    text = decode_lossy(body)
    stated = F.get(F.when(text.rlike("(?i)<base\\s"), attributes(text, "base", "href")), F.lit(0))
    return F.when(stated.isNotNull(), join_url(page, stated)).otherwise(page)


def markdown_links(text: Column) -> Column:
    """Targets of Markdown links that lead to pages, in order."""
    found = F.regexp_extract_all(text, F.lit(MARKDOWN_LINK), F.lit(1))
    return F.filter(F.transform(found, strip), lambda h: (h != "") & ~_leads_nowhere(h))


def unwrap_envelope(text: Column) -> Column:
    """The text inside a JSON wrapper's ``body``, else ``content``; null if there is none.

    Empty, null, false and zero values count as absent.
    """
    parsed = F.when(F.ltrim(text, F.lit(BYTE_WHITESPACE)).startswith("{"), strict_json(text))

    def part(name: str) -> Column:
        value = F.try_variant_get(parsed, f"$.{name}", "variant")
        kind = F.schema_of_variant(value)
        shown = F.to_json(value)
        empty = shown.isin('""', "null", "false", "0", "0.0", "[]", "{}")
        return F.when(
            value.isNotNull() & ~empty,
            F.struct((kind == "STRING").alias("is_text"), F.try_variant_get(value, "$", "string").alias("text")),
        )

    chosen = F.coalesce(part("body"), part("content"))
    return F.when(chosen["is_text"], chosen["text"])


def page_links(body: Column) -> Column:
    """Links of a page: inside a JSON wrapper if there is one; HTML links, or Markdown links
    where there are none. Entities are decoded outside of wrappers only."""
    text = decode_lossy(body)
    inner = unwrap_envelope(text)
    outer_html, inner_html = html_links(text), wrapped_links(inner)
    return F.when(
        inner.isNotNull(), F.when(F.size(inner_html) > 0, inner_html).otherwise(markdown_links(inner))
    ).otherwise(F.when(F.size(outer_html) > 0, outer_html).otherwise(markdown_links(text)))


def extract_links(df: DataFrame, links: Column, *ids: str) -> DataFrame:
    """One row per link: the given columns, its ordinal ``ord`` and ``href``."""
    return explode_rows(df, ids, links, "href", "ord")


def resolve_links(links: DataFrame, page: str, href: str = "href", out: str = "url") -> DataFrame:
    """Add the absolute URL; anchors, mail and script links are dropped. ``page`` names the URL that links
    are relative to (see ``base_href``)."""
    kept = links.filter((F.col(href) != "") & ~_leads_nowhere(F.col(href)))
    # made as a row, so that later filters on the URL are not pushed below it, which would
    # join the same link once per condition
    return explode_rows(kept, kept.columns, F.array(join_url(F.col(page), F.col(href))), out)


def filter_links(
    links: DataFrame,
    url: str = "url",
    hosts: Sequence[str] | DataFrame | None = None,
    include: str | None = None,
    exclude: str | None = None,
) -> DataFrame:
    """Links a crawl would follow: http(s), printable ASCII path and query once decoded, an
    allowed host, the include pattern and not the exclude pattern.

    ``hosts`` is a short list, or a table with a ``host`` column (seeds can be many: it is
    semi-joined, not collected); ``None`` allows every host.
    """
    target = F.col(url)
    keep = url_scheme(target).isin("http", "https") & is_plain_ascii_url(target)
    if include:
        keep = keep & target.rlike(include)
    if exclude:
        keep = keep & ~target.rlike(exclude)
    kept = links.filter(keep)
    if hosts is None:
        return kept
    host = F.coalesce(url_host(target), F.lit(""))
    if not isinstance(hosts, DataFrame):
        return kept.filter(host.isin(*[h.lower().strip() for h in hosts if h]))
    allowed = hosts.select(F.lower("host").alias("__host")).distinct()
    return kept.withColumn("__host", host).join(allowed, "__host", "left_semi").drop("__host")


def count_links(df: DataFrame, links: Column, *ids: str) -> DataFrame:
    """Number of links per page, counted inside the row."""
    return df.select(*ids, F.size(links).alias("n_links"))


def contact_links(df: DataFrame, body: str, *ids: str) -> DataFrame:
    """Mail, phone and all links of a page as lists, built inside the row."""
    found = df.select(*ids, html_links(decode_lossy(F.col(body))).alias("links"))
    return found.select(
        *ids,
        F.filter("links", lambda h: h.startswith("mailto:")).alias("emails"),
        F.filter("links", lambda h: h.startswith("tel:")).alias("phones"),
        "links",
    )


def site_link_graph(links: DataFrame, source: str, target: str) -> DataFrame:
    """Links out of and into every host, with the distinct URLs on the other end.

    Each link feeds both of its hosts in one pass; the distinct counts shuffle by host AND
    URL first, so that a host with a third of all links is still spread out.
    """
    ends = F.array(
        F.struct(url_host(F.col(source)).alias("host"), F.col(target).alias("out_url"), F.lit(None).cast("string").alias("in_url")),
        F.struct(url_host(F.col(target)).alias("host"), F.lit(None).cast("string").alias("out_url"), F.col(source).alias("in_url")),
    )
    return (
        links.select(F.explode(ends).alias("e"))
        .select("e.*")
        .groupBy("host")
        .agg(
            F.count("out_url").alias("links_out"),
            F.count("in_url").alias("links_in"),
            F.count_distinct("out_url").alias("pages_out"),
            F.count_distinct("in_url").alias("pages_in"),
        )
    )
