"""URL column expressions: parsing, normalising, joining, filtering."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URI-splitting pattern of RFC 3986 appendix B with the scheme alphabet of §3.1.
URI_PATTERN = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)


@dataclass(frozen=True)
class UrlParts:
    scheme: Column
    host: Column
    path: Column
    query: Column


# a character that no text may contain, put between the parts
_MARK = "\ufdd0"


def _bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def with_parts(url: Column, fn: Callable[[UrlParts], Column]) -> Column:
    """An expression over scheme (lowercase), host part, path and query; absent parts are ``''``.

    Regular expressions never raise, while ``parse_url`` does on bad input under ANSI mode. One
    replacement finds all parts, and it runs once per URL.
    """
    marked = F.regexp_replace(url, URI_PATTERN, _MARK.join(("$1", "$2", "$3", "$4")))

    def over(parts: Column) -> Column:
        at = lambda i: F.get(parts, F.lit(i))
        return fn(UrlParts(F.lower(at(0)), at(1), at(2), at(3)))

    return _bind(F.split(marked, _MARK, 4), over)


def _prefixed(mark: str, text: Column) -> Column:
    return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit(mark), text))


def _strip_slashes(text: Column) -> Column:
    return F.rtrim(text, F.lit("/"))


def normalize_batch_url(url: Column) -> Column:
    """Key used to deduplicate inputs: scheme and host lowercase, no fragment, no
    trailing ``/``. Values without a scheme (queries, product codes) stay as they are."""

    def rebuilt(parts: UrlParts) -> Column:
        whole = F.concat(
            parts.scheme,
            F.lit(":"),
            _prefixed("//", F.lower(parts.host)),
            parts.path,
            _prefixed("?", parts.query),
        )
        return F.when(parts.scheme == "", url).otherwise(_strip_slashes(whole))

    return with_parts(url, rebuilt)


def normalize_crawl_url(url: Column) -> Column:
    """Key used by the crawl's seen-set: no fragment, ``…/index.html`` means its folder,
    no trailing ``/`` except for the root; query and host case are kept."""

    def rebuilt(parts: UrlParts) -> Column:
        trimmed = _strip_slashes(F.regexp_replace(parts.path, r"(?i)/index\.html?$", "/"))
        path = F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("/"))
        return F.concat(parts.scheme, F.lit("://"), parts.host, path, _prefixed("?", parts.query))

    return with_parts(url, rebuilt)


def ensure_scheme(url: Column) -> Column:
    """Prefix ``https://`` unless the value already names http, https or ftp."""
    known = url.startswith("http://") | url.startswith("https://") | url.startswith("ftp://")
    return F.when(known | (url == ""), url).otherwise(F.concat(F.lit("https://"), url))


def url_scheme(url: Column) -> Column:
    """Lowercase scheme, ``''`` without one."""
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def url_host(url: Column) -> Column:
    """Lowercase host part (with port), null when the URL has none."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))
    return F.when(host != "", host)


# Fixed value: the URL shapes that carry an 11-character video id.
VIDEO_URL_PATTERN = (
    r"(?:youtube\.com/(?:watch\?v=|shorts/|embed/)|youtu\.be/)([a-zA-Z0-9_-]{11})"
)


def video_id(value: Column) -> Column:
    """The video id inside a watch, shorts, embed or short URL, else the value itself."""
    found = F.regexp_extract(value, VIDEO_URL_PATTERN, 1)
    return F.when(found == "", value).otherwise(found)


def _without_dot_segments(path: Column) -> Column:
    """RFC 3986 §5.2.4 as an array fold; runs only for paths that have dot segments."""
    parts = F.split(path, "/", -1)
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda kept, part: F.when(
            part == "..",
            # the empty first part stands for the leading "/" and is never popped
            F.when(F.size(kept) > 1, F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))).otherwise(kept),
        )
        .when(part == ".", kept)
        .otherwise(F.concat(kept, F.array(part))),
    )
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    joined = F.concat(F.array_join(folded, "/"), F.when(ends_in_dots, F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def join_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on the page ``base``. Dot segments are resolved in links
    relative to the page's host; a link with a host of its own stays as it is."""
    fragment = _prefixed("#", F.regexp_extract(href, URI_PATTERN, 5))

    def joined(page: UrlParts, link: UrlParts) -> Column:
        origin = F.concat(page.scheme, F.lit("://"), page.host)
        tail = F.concat(_prefixed("?", link.query), fragment)
        own_scheme = (link.scheme != "") & ((link.scheme != page.scheme) | (link.host != ""))
        folder = F.regexp_replace(F.coalesce(F.nullif(page.path, F.lit("")), F.lit("/")), r"[^/]*$", "")
        query = F.when(link.query != "", link.query).otherwise(page.query)
        return (
            F.when(href == "", base)
            .when(own_scheme, F.concat(link.scheme, F.lit(":"), _prefixed("//", link.host), link.path, tail))
            .when(
                href.startswith("//"),
                F.concat(page.scheme, F.lit("://"), link.host, link.path, tail),
            )
            .when(link.path == "", F.concat(origin, page.path, _prefixed("?", query), fragment))
            .when(link.path.startswith("/"), F.concat(origin, _without_dot_segments(link.path), tail))
            .otherwise(F.concat(origin, _without_dot_segments(F.concat(folder, link.path)), tail))
        )

    return with_parts(base, lambda page: with_parts(href, lambda link: joined(page, link)))


def is_plain_ascii_url(url: Column) -> Column:
    """Decoded path and query hold printable ASCII only.

    A ``%XX`` escape decodes to printable ASCII exactly for 20..7E, so the test needs no decoding.
    """
    odd = r"[^\x20-\x7E]|%(?:[01][0-9A-Fa-f]|7[Ff]|[89A-Fa-f][0-9A-Fa-f])"
    # behind the host and before the fragment; a host ends at the first "/", "?" or "#"
    # (possessive, so that no host character is taken for a path's)
    return ~url.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*+:)?+(?://[^/?#]*+)?+[^#]*?(?:" + odd + ")")
