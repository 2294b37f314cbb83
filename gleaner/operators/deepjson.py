"""JSON text of any nesting: the standard library, and a walk with a stack of its own where that gives up."""

from __future__ import annotations

import json
import re
from typing import Any

_BLANK = re.compile(r"[ \t\n\r]*")


def _scalar(text: str, at: int) -> tuple[Any, int]:
    return json.JSONDecoder().raw_decode(text, at)


def loads(text: str) -> Any:
    try:
        return json.loads(text)
    except RecursionError:
        return _walk(text)


def _walk(text: str) -> Any:
    holders: list[dict | list] = []
    names: list[str] = []
    at = _BLANK.match(text, 0).end()

    def fail() -> None:
        raise ValueError(f"not JSON at {at}")

    while True:
        # a value starts here
        opening = text[at : at + 1]
        if opening in ("{", "["):
            holder: dict | list = {} if opening == "{" else []
            at = _BLANK.match(text, at + 1).end()
            closing = "}" if opening == "{" else "]"
            if text[at : at + 1] != closing:
                holders.append(holder)
                if opening == "{":
                    at = _name(text, at, names)
                continue
            value, at = holder, at + 1
        else:
            try:
                value, at = _scalar(text, at)
            except RecursionError:
                fail()
        # a value has ended: it goes where it belongs, and closes what it completes
        while True:
            at = _BLANK.match(text, at).end()
            if not holders:
                if at != len(text):
                    fail()
                return value
            holder = holders[-1]
            if isinstance(holder, dict):
                holder[names.pop()] = value
            else:
                holder.append(value)
            sign = text[at : at + 1]
            at = _BLANK.match(text, at + 1).end() if sign == "," else at + 1
            if sign == ",":
                if isinstance(holder, dict):
                    at = _name(text, at, names)
                break
            if sign != ("}" if isinstance(holder, dict) else "]"):
                fail()
            value = holders.pop()


def _name(text: str, at: int, names: list[str]) -> int:
    """Read a key and its colon; returns where the value starts."""
    if text[at : at + 1] != '"':
        raise ValueError(f"not JSON at {at}")
    name, at = _scalar(text, at)
    names.append(name)
    at = _BLANK.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(f"not JSON at {at}")
    return _BLANK.match(text, at + 1).end()


def dumps(value: Any) -> str:
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        return "".join(_pieces(value))


def _pieces(value: Any):
    waiting: list[tuple[Any, str]] = [(iter((("", value),)), "")]
    while waiting:
        items, closing = waiting[-1]
        for lead, item in items:
            yield lead
            if isinstance(item, dict) and item:
                keys = (json.dumps("null" if k is None else k, ensure_ascii=False) for k in item)
                leads = (("" if n == 0 else ", ") + k + ": " for n, k in enumerate(keys))
                yield "{"
                waiting.append((zip(leads, item.values()), "}"))
                break
            if isinstance(item, list) and item:
                yield "["
                waiting.append(((("" if n == 0 else ", ", x) for n, x in enumerate(item)), "]"))
                break
            yield json.dumps(item, ensure_ascii=False)
        else:
            yield closing
            waiting.pop()
