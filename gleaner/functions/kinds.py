"""Content typing: which kind of payload is this, and where does it belong?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .jsontext import strict_json
from .text import BYTE_WHITESPACE

# Content types and the file kinds they stand for, the kinds recognised at the end
# of a URL path, and the kinds stored apart from the text payloads.
CONTENT_TYPE_KINDS = {
    "application/json": "json",
    "application/ld+json": "json",
    "text/html": "html",
    "text/markdown": "md",
    "text/plain": "txt",
    "image/png": "png",
    "image/jpeg": "jpg",
    "image/jpg": "jpg",
    "image/gif": "gif",
    "image/webp": "webp",
    "image/svg+xml": "svg",
    "application/pdf": "pdf",
    "application/zip": "zip",
}
URL_PATH_KINDS = (
    "html", "htm", "xml", "json", "zip", "pdf", "md", "txt", "svg",
    "png", "jpg", "jpeg", "gif", "webp", "ico", "css", "js",
)
IMAGE_KINDS = ("png", "jpg", "gif", "webp")
ARCHIVE_KINDS = ("pdf", "zip")

_SNIFF_WINDOW = 2048
_HEAD = 2 * _SNIFF_WINDOW


def _latin(body: Column) -> Column:
    """One character per byte, so that byte positions and text positions agree."""
    return F.decode(body.cast("binary"), "ISO-8859-1")


def _head_without_blanks(body: Column, window: int) -> Column:
    """At least ``window`` bytes after the leading blanks (all there are, if fewer)."""
    raw = body.cast("binary")
    head = F.ltrim(_latin(F.substring(raw, 1, 2 * window)), F.lit(BYTE_WHITESPACE))
    whole = F.ltrim(_latin(raw), F.lit(BYTE_WHITESPACE))
    enough = (F.octet_length(raw) <= 2 * window) | (F.length(head) >= window)
    return F.when(enough, head).otherwise(whole)


def sniff_kind(body: Column) -> Column:
    """Kind told by the first bytes, null when they tell nothing."""
    head = _head_without_blanks(body, _SNIFF_WINDOW)
    json_like = head.rlike(r"\A[{\[][ \t\n\r\x0B\f]*(?:\z|[\"{\[}\]0-9\-ntf])")
    # a Markdown body must open with the bracket itself, without blanks before it
    opens_with_bracket = F.substring(body.cast("binary"), 1, 1) == F.lit(b"[")
    link_like = opens_with_bracket & F.substring(head, 1, _SNIFF_WINDOW).contains("](")
    return (
        F.when(head.startswith("\x89PNG\r\n\x1a\n"), "png")
        .when(head.startswith("\xff\xd8"), "jpg")
        .when(head.startswith("GIF8"), "gif")
        .when(head.startswith("RIFF") & (F.substring(head, 9, 4) == "WEBP"), "webp")
        .when(json_like, "json")
        .when(link_like, "md")
        .when(head.startswith("<!") | head.startswith("<html") | head.startswith("<HTML"), "html")
    )


def header_value(headers: Column, name: str) -> Column:
    """Value of a header whatever the case of its name; null if absent or empty."""
    hits = F.filter(
        F.map_entries(headers), lambda e: (F.lower(e["key"]) == name.lower()) & (e["value"] != "")
    )
    return F.try_element_at(hits, F.lit(1))["value"]


def kind_from_content_type(headers: Column) -> Column:
    """Kind named by the content type, ``bin`` when it is unknown."""
    main = F.lower(F.btrim(F.substring_index(header_value(headers, "content-type"), ";", 1)))
    pairs = [F.lit(x) for pair in CONTENT_TYPE_KINDS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(main, F.lit(""))), F.lit("bin"))


def kind_from_url_path(url: Column) -> Column:
    """Known kind at the end of the URL path, else null."""
    # a trailing ";parameter" does not belong to the path
    path = F.regexp_extract(url, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    kept = F.btrim(F.regexp_replace(path, r";[^/]*$", ""), F.lit("/"))
    ending = F.lower(F.regexp_extract(kept, r"\.([^./]*)$", 1))
    return F.when(ending.isin(*URL_PATH_KINDS), ending)


def resolve_kind(forced: Column, url: Column, body: Column, headers: Column) -> Column:
    """Forced kind, else URL path, else first bytes, else content type, else ``bin``."""
    return F.coalesce(forced, kind_from_url_path(url), sniff_kind(body), kind_from_content_type(headers))


def route_kind(kind: Column) -> Column:
    """Folder for a kind: images and archives apart, everything else at the top (``''``)."""
    return (
        F.when(kind.isin(*IMAGE_KINDS), "screenshots").when(kind.isin(*ARCHIVE_KINDS), "files").otherwise("")
    )


# Byte prefixes of binary files, one character per byte.
BINARY_PREFIXES = (
    "\x89PNG\r\n", "\xff\xd8\xff", "%PDF", "GIF87a", "GIF89a", "PK\x03\x04", "\x7fELF", "RIFF",
)


def is_text_payload(body: Column) -> Column:
    """Known binary prefixes are not text; JSON, markup and headings are; otherwise no
    NUL and at most 30 % control bytes in the first 512 bytes."""
    head = _latin(F.substring(body.cast("binary"), 1, 512))
    binary = F.lit(False)
    for prefix in BINARY_PREFIXES:
        binary = binary | head.startswith(prefix)
    controls = F.regexp_count(head, F.lit(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"))
    return (
        F.when(head == "", True)
        .when(binary, False)
        .when(head.rlike(r"\A[{\[<#]"), True)
        .when(head.contains("\x00"), False)
        .otherwise(~(controls / F.length(head) > 0.30))
    )


def truthy(params: Column, name: str) -> Column:
    """A request parameter is on when it reads true, 1 or yes."""
    return F.coalesce(F.lower(F.try_element_at(params, F.lit(name))).isin("true", "1", "yes"), F.lit(False))


def given(params: Column, name: str) -> Column:
    """A request parameter is present and not empty."""
    return F.coalesce(F.try_element_at(params, F.lit(name)) != "", F.lit(False))


def wants_screenshot(params: Column) -> Column:
    return truthy(params, "screenshot") | truthy(params, "screenshot_full_page") | given(params, "screenshot_selector")


def wants_extraction(params: Column) -> Column:
    return given(params, "extract_rules") | given(params, "ai_extract_rules") | given(params, "ai_query")


def kind_from_request(params: Column) -> Column:
    """Kind that a request forces, null when the response has to tell."""
    wrapped = truthy(params, "json_response")
    return (
        F.when(wants_screenshot(params) & wrapped, "json")
        .when(wants_screenshot(params), "png")
        .when(truthy(params, "return_page_markdown"), "md")
        .when(truthy(params, "return_page_text"), "txt")
        .when(wrapped | wants_extraction(params), "json")
    )


def embedded_binary(body: Column, field: str = "screenshot") -> Column:
    """Bytes of a base64 field of a JSON wrapper; null when absent or unreadable."""
    wrapper = strict_json(body.cast("string"))
    return F.try_to_binary(F.try_variant_get(wrapper, f"$.{field}", "string"), F.lit("base64"))


def embedded_length(body: Column, field: str = "body") -> Column:
    """Characters of a text field of a JSON wrapper."""
    return F.length(F.try_variant_get(strict_json(body.cast("string")), f"$.{field}", "string"))
