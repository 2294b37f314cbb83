"""Payload readers of the shredding job: bytes in, one tree value (dict, list or scalar) out.

A reader raises ``ValueError`` for a payload that is not of its format.
"""

from __future__ import annotations

import csv
import io
import re
import xml.etree.ElementTree as ET
from html.parser import HTMLParser
from itertools import chain, count, repeat
from typing import Any

from . import deepjson

# Fixed values of HTML: elements without content, and the open elements that a start tag closes.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)
CLOSED_BY_START = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
    **{tag: {"p"} for tag in BLOCK_TAGS},
}
SCOPE_TAGS = frozenset({"table", "ul", "ol", "dl", "select", "html", "body"})

# Fixed values of the detection: how an XML payload announces itself and how far that is looked for, how long a
# column name may be, where a Markdown heading has to show up (bytes, and lines), and the names in records.
XML_MARKS = (b"<?xml", b"<rss", b"<feed")
XML_WINDOW = 200
MAX_COLUMN_NAME = 60
MARKDOWN_WINDOW = 1000
HEADING_LINES = 100
TEXT, LOOSE, TABLES = "text", "tail_text", "tables"


class _Element:
    """An element that is still open: its record so far, and where text that comes now belongs."""

    __slots__ = ("tag", "record", "own", "takes")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag = tag
        self.record: dict[str, Any] = dict(attributes)
        self.own = ""
        self.takes: str | None = TEXT

    def put(self, name: str, value: Any, first: Any) -> None:
        """Enter a value under a name; a name that comes again holds a list."""
        if name not in self.record:
            self.record[name] = first
        elif isinstance(self.record[name], list):
            self.record[name].append(value)
        else:
            self.record[name] = [self.record[name], value]


class _Values:
    """Makes values out of markup events as elements end, without a tree of elements and without recursion.

    An element's value is its text if there is nothing else, ``""`` if it is empty, else a record: attributes, children by
    tag (repeats as a list), text after children in ``tail_text`` and text before them in ``text``. Comments are left out together
    with the text up to the next element.
    """

    def __init__(self) -> None:
        self.open = [_Element("", {})]
        self.words: list[str] = []
        self.top: list[tuple[str, Any]] = []  # the outermost elements

    def _settle(self) -> _Element:
        """Give the text read since the last event to the innermost open element."""
        element, words = self.open[-1], "".join(self.words).strip()
        self.words.clear()
        if words and element.takes == TEXT:
            element.own = words
        elif words and element.takes == LOOSE:
            element.put(LOOSE, words, [words])
        return element

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        self._settle()
        self.open.append(_Element(tag, attributes))

    def data(self, text: str) -> None:
        self.words.append(text)

    def comment(self, _text: str) -> None:
        self._settle().takes = None

    def pi(self, _target: str, _text: str | None = None) -> None:
        self._settle().takes = None

    def end(self, _tag: str) -> None:
        value, tag, outer = self.close(), self.open.pop().tag, self.open[-1]
        outer.put(tag, value, value)
        outer.takes = LOOSE
        if len(self.open) == 1:
            self.top.append((tag, value))

    def close(self) -> Any:
        """The value of the innermost open element."""
        element = self._settle()
        if element.own:
            element.record[TEXT] = element.own
        return element.own if element.record.keys() <= {TEXT} else element.record


class _HtmlEvents(HTMLParser):
    """Passes on balanced events; unclosed elements end where HTML implies it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.values = _Values()
        self.open: list[str] = []

    def _close_down_to(self, index: int) -> None:
        while len(self.open) > index:
            self.values.end(self.open.pop())

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends = CLOSED_BY_START.get(tag, ())
        for index in range(len(self.open) - 1, -1, -1):
            if self.open[index] in ends:
                self._close_down_to(index)
                break
            if self.open[index] in SCOPE_TAGS:
                break
        named: dict[str, str] = {}
        for name, value in attrs:
            named.setdefault(name, value or "")
        self.values.start(tag, named)
        if tag in VOID_TAGS:
            self.values.end(tag)
        else:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.open and self.open[-1] == tag:
            self._close_down_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            self._close_down_to(len(self.open) - 1 - self.open[::-1].index(tag))

    def handle_data(self, data: str) -> None:
        self.values.data(data)

    def handle_comment(self, data: str) -> None:
        self.values.comment(data)

    def value(self) -> Any:
        """The ``html`` element, else the only outermost one, else a record of all of these."""
        self.close()
        self._close_down_to(0)
        top = self.values.top
        chosen = [value for tag, value in top if tag == "html"] or [value for _, value in top]
        if not chosen:
            raise ValueError("no element")
        return chosen[0] if len(top) == 1 or "html" in dict(top) else self.values.close()


def read_html(text: str) -> Any:
    events = _HtmlEvents()
    events.feed(text)
    return events.value()


def read_xml(body: bytes) -> Any:
    values = _Values()
    reader = ET.XMLParser(target=values)
    try:
        reader.feed(body)
        reader.close()
    except (ET.ParseError, LookupError) as error:
        raise ValueError("malformed markup") from error
    return values.top[0][1]


def read_csv(text: str) -> list[dict]:
    """Records by column name: two different short names or more, and a first record no longer than the header.

    What later records hold beyond the header stands under the name null; cells that a record lacks are null.
    """
    try:
        header, *records = csv.reader(io.StringIO(text))
    except csv.Error as error:
        raise ValueError("broken quoting") from error
    records = [record for record in records if record]
    width, names = len(header), set(header)
    if not records or len(records[0]) > width or len(names) < 2 or max(map(len, names)) > MAX_COLUMN_NAME:
        raise ValueError("no table")
    named = (dict(zip(header, chain(record, repeat(None)))) for record in records)
    return [row | {None: record[width:]} if len(record) > width else row for row, record in zip(named, records)]


def read_ndjson(text: str) -> list:
    """JSON values on lines of their own, at least two."""
    values = [deepjson.loads(bare) for bare in map(str.strip, text.split("\n")) if bare]
    if len(values) < 2:
        raise ValueError("a single line")
    return values


# Markdown is cut by patterns over the whole text, with a line end put before it. In these, [^\S\n] is a blank inside a line.
_HEADING = re.compile(
    r"""\n(?: [^\S\n]* (?P<first>\S.*)       \n ={3,} [^\S\n]* $
            | [^\S\n]* (?P<second>[^\s|].*)  \n -{3,} [^\S\n]* $
            | (?P<marks>[#]{1,6}) [^\S\n]+ (?P<title>.*) )""",
    re.MULTILINE | re.VERBOSE,
)
_TABLE = re.compile(r"(\n[^\S\n]*\|[^|\n]*\|.*(?:\n[^\S\n]*\|[^|\n]*\|.*)*)")
_BAR = re.compile(r"\s*\|\s*")
_RULE_CELL = re.compile(r":?-+:?")
_FIRST_LINES = re.compile(r"(?:.*\n){0,%d}.*" % (HEADING_LINES - 1))
_HEADING_SIGN = re.compile(r"^(?:#{1,6}[^\S\n]|[=-]{3,}[^\S\n]*$)", re.MULTILINE)
_OPENING_SIGN = re.compile(r"^#{1,6}\s|^.+\n={3,}\s*$", re.MULTILINE)


def _table_records(table: str) -> list[dict[str, str]]:
    """A header, a rule and records; anything else between bars holds none."""
    rows = [_BAR.split(line.strip("|").strip()) for line in table.split("\n")[1:]]
    if len(rows) < 3:
        return []
    names = list(filter(None, rows[0]))
    ruled = all(map(_RULE_CELL.fullmatch, filter(None, rows[1])))
    return [dict(zip(names, chain(row, repeat("")))) for row in rows[2:]] if names and ruled else []


def _section(body: str) -> dict[str, Any]:
    """What stands between two headings: words and records of tables, whichever comes first."""
    section: dict[str, Any] = {}
    for place, part in enumerate(_TABLE.split(body)):
        name, found = (TABLES, _table_records(part)) if place % 2 else (TEXT, list(filter(None, [part.strip()])))
        if found:
            section.setdefault(name, []).extend(found)
    if TEXT in section:
        section[TEXT] = "\n".join(section[TEXT])
    return section


def read_markdown(text: str) -> dict:
    """Sections by title, each inside the nearest one of a higher level; titles that repeat are numbered."""
    if not _HEADING_SIGN.search(_FIRST_LINES.match(text)[0]):
        raise ValueError("no heading near the top")
    text = f"\n{text}"
    headings = list(_HEADING.finditer(text))
    ends = [heading.start() for heading in headings] + [len(text)]
    root = _section(text[: ends[0]])
    outline = {0: root}  # the open section of each level
    numbers: dict[tuple[int, str], Any] = {}
    for heading, end in zip(headings, ends[1:]):
        level = len(heading["marks"] or "") or (1 if heading["first"] else 2)
        title = (heading["first"] or heading["second"] or heading["title"]).strip()
        outline = {upper: section for upper, section in outline.items() if upper < level}
        parent = outline[max(outline)]
        tried = numbers.setdefault((id(parent), title), chain([title], (f"{title} ({n})" for n in count(2))))
        outline[level] = parent[next(name for name in tried if name not in parent)] = _section(text[heading.end() : end])
    if not root:
        raise ValueError("nothing in it")
    return root


def _lossy(body: bytes) -> str:
    return body.decode("utf-8", "replace")


# In the order in which they are tried: whether a payload, without blanks in front, looks like the format, and its reader.
READERS = {
    "json": (lambda bare: bare[:1] in b"{[", lambda body: deepjson.loads(_lossy(body))),
    "ndjson": (lambda bare: bare[:1] in b"{[", lambda body: read_ndjson(_lossy(body))),
    "xml": (lambda bare: bare[:1] == b"<" and any(mark in bare[:XML_WINDOW].lower() for mark in XML_MARKS), read_xml),
    "html": (lambda bare: bare[:1] == b"<", lambda body: read_html(_lossy(body))),
    "csv": (lambda bare: b"," in bare and b"\n" in bare, lambda body: read_csv(_lossy(body))),
    "markdown": (lambda bare: _OPENING_SIGN.search(_lossy(bare[:MARKDOWN_WINDOW])), lambda body: read_markdown(_lossy(body))),
    "text": (lambda bare: True, lambda body: _lossy(body).splitlines()),
}
FORMATS = tuple(READERS)


def parse_payload(body: bytes | None, forced: str | None = None) -> tuple[str | None, Any]:
    """(format, tree); the format is ``None`` for a blank or, if forced, unparsable body."""
    bare = body.lstrip() if body else b""
    if not bare:
        return None, None
    for name in FORMATS if forced is None else [forced]:
        like, read = READERS[name]
        if forced or like(bare):
            try:
                return name, read(body)
            except ValueError:
                continue
    return None, None
