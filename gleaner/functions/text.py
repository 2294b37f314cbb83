"""Text column expressions: whitespace, lines, lossy decoding, value patterns, chunks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace that a Unicode-aware strip removes, the blanks that a byte-wise
# strip removes, and the line ends that a Unicode-aware line split knows.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BYTE_WHITESPACE = " \t\n\r\x0b\x0c"
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def decode_lossy(body: Column) -> Column:
    """Bytes as UTF-8 text, bad sequences replaced."""
    return F.make_valid_utf8(body.cast("string"))


def split_lines(text: Column) -> Column:
    """Lines of a text without their ends; no extra line after a final line end."""
    lines = F.split(text, LINE_END, -1)
    ends_clean = F.element_at(lines, -1) == ""
    return F.when(ends_clean, F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def glob_to_regex(glob: str) -> str:
    """Case-sensitive glob (``*``, ``?``, ``[…]``) as an anchored regular expression."""
    out, at = ["(?s)\\A"], 0
    while at < len(glob):
        char = glob[at]
        close = glob.find("]", at + 2) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif close > 0:
            chars = glob[at + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append("[" + ("^" + chars[1:] if chars[0] == "!" else chars.replace("^", "\\^", 1) if chars[0] == "^" else chars) + "]")
            at = close
        else:
            out.append(re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", char) if char.isascii() else char)
        at += 1
    return "".join(out) + "\\z"


def value_pattern(pattern: str) -> tuple[str, str] | None:
    """What a value pattern tests: ``("regex", r)`` or ``("contains", text)``.

    ``/regex/`` searches, a ``*`` makes it a glob over the whole value, else it is a substring. An
    unusable regular expression matches nothing: ``None``.
    """
    if len(pattern) > 1 and pattern.startswith("/") and pattern.endswith("/"):
        try:
            re.compile(pattern[1:-1])
        except re.error:
            return None
        return "regex", "(?U)" + pattern[1:-1]
    if "*" in pattern:
        return "regex", glob_to_regex(pattern)
    return "contains", pattern


def matches(value: Column, pattern: str) -> Column:
    """Does the text match the value pattern?"""
    test = value_pattern(pattern)
    if test is None:
        return F.lit(False)
    return value.rlike(test[1]) if test[0] == "regex" else value.contains(test[1])


def chunk_array(text: Column, size: int, overlap: int = 0) -> Column:
    """Windows of ``size`` characters that share ``overlap`` characters with their neighbour.

    Every start offset below the length gives a chunk, also when a short tail lies
    inside the chunk before it; an empty text gives none.
    """
    if size <= 0:
        return F.array(text)
    step = size - max(0, min(overlap, size - 1))
    starts = F.sequence(F.lit(0), F.greatest(F.length(text), F.lit(1)) - 1, F.lit(step))
    pieces = F.transform(starts, lambda at: F.substring(text, at + 1, F.lit(size)))
    return F.when(F.length(text) > 0, pieces).otherwise(F.array().cast("array<string>"))
