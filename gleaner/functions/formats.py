"""The format of a payload, told by Spark's own parsers and patterns: no Python, nothing is kept of what is parsed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .jsontext import strict_json
from .text import BYTE_WHITESPACE, decode_lossy

# What an XML payload begins with, how far that is looked for, how long a column name may be, and
# where a Markdown heading has to show up.
XML_MARKS = ("<?xml", "<rss", "<feed")
XML_WINDOW = 200
MAX_COLUMN_NAME = 60
MARKDOWN_WINDOW = 1000
HEADING_LINES = 100

_RECORD = r'\A[\r\n]*((?:[^"\r\n]++|"[^"]*+"?)*+)'  # one CSV record: line ends inside quotes belong to it
_CELL = r'(?:^|,)((?:[^",]++|"[^"]*+"?)*+)'
_ATX = r"(?m)^#{1,6}\s"
_SETEXT = r"(?m)^.+\n={3,}\s*$"
_HEADING = r"\A(#{1,6}\s|[=-]{3,}\s*\z)"


def is_json(text: Column) -> Column:
    return strict_json(text).isNotNull()


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BYTE_WHITESPACE))), lambda x: x != "")


def is_ndjson(text: Column) -> Column:
    """Two or more lines that are not blank, each of them JSON."""
    return (F.size(_lines(text)) >= 2) & F.forall(_lines(text), lambda x: strict_json(x).isNotNull())


def ndjson_list(body: Column) -> Column:
    """The lines of an NDJSON payload as one JSON list, which paths and records read like any other; null for other payloads."""
    text = decode_lossy(body)
    return F.when(is_ndjson(text), F.concat(F.lit("["), F.array_join(_lines(text), ","), F.lit("]")))


def is_xml(text: Column) -> Column:
    """Well-formed: the reader has nothing to set aside as corrupt."""
    read = F.from_xml(text, "_corrupt_record string", {"mode": "PERMISSIVE"})
    return read.isNotNull() & read["_corrupt_record"].isNull()


def is_csv(text: Column) -> Column:
    """A header of two or more different short names, and a first row with no more cells than that."""
    header = F.regexp_extract(text, _RECORD, 1)
    rest = F.regexp_replace(text, _RECORD, "")
    first = F.regexp_extract(rest, _RECORD, 1)
    cells = lambda record: F.regexp_extract_all(record, F.lit(_CELL), F.lit(1))
    names = F.transform(cells(header), lambda c: F.replace(F.regexp_replace(c, r'\A"|"\z', ""), F.lit('""'), F.lit('"')))
    short = F.forall(names, lambda n: F.length(n) <= MAX_COLUMN_NAME)
    return (F.size(F.array_distinct(names)) >= 2) & short & (F.length(first) > 0) & (F.size(cells(first)) <= F.size(names))


def is_markdown(text: Column, bare: Column) -> Column:
    """A heading near the top, also among the first lines."""
    opening = decode_lossy(F.substring(bare.cast("binary"), 1, MARKDOWN_WINDOW))
    near = F.slice(F.split(text, "\n", HEADING_LINES + 1), 1, HEADING_LINES)
    return (opening.rlike(_ATX) | opening.rlike(_SETEXT)) & F.exists(near, lambda x: x.rlike(_HEADING))


def format_of(body: Column) -> Column:
    """``json``, ``ndjson``, ``xml``, ``html``, ``csv``, ``markdown`` or ``text``; null for a blank payload.

    Each format is tried where the payload begins like it: what begins like JSON is parsed as a whole, then line by
    line; markup is XML if it says so and is well-formed, else HTML if it has an element. JSON with a key twice in an object is none.
    """
    text = decode_lossy(body)
    bare = F.ltrim(text, F.lit(BYTE_WHITESPACE))
    start = F.left(bare, F.lit(1))
    like_json, like_markup = start.isin("{", "["), start == "<"
    head = F.lower(F.left(bare, F.lit(XML_WINDOW)))
    says_xml = head.contains(XML_MARKS[0]) | head.contains(XML_MARKS[1]) | head.contains(XML_MARKS[2])
    rows = bare.contains(",") & bare.contains("\n")
    return (
        F.when((bare == "") | bare.isNull(), F.lit(None).cast("string"))
        .when(like_json & is_json(text), "json")
        .when(like_json & is_ndjson(text), "ndjson")
        .when(like_markup & says_xml & is_xml(bare), "xml")
        .when(like_markup & bare.rlike("<[A-Za-z]"), "html")
        .when(rows & is_csv(text), "csv")
        .when(is_markdown(text, bare), "markdown")
        .otherwise("text")
    )
