"""JSON pointers: the leaves of a JSON text, what a pointer finds, and a value put in its place.

Defined results: null or unreadable JSON has no leaves; an empty object or array is a leaf
unless ``empties`` is false; the leaf of a bare value has the pointer "/".
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .jcs import canonical


class PointerError(ValueError):
    """A pointer that is not absolute or finds nothing."""


def escape(token: str) -> str:
    return token.replace("~", "~0").replace("/", "~1")


def tokens(pointer: str) -> list[str]:
    if pointer and pointer[0] != "/":
        raise PointerError("not absolute")
    return [t.replace("~1", "/").replace("~0", "~") for t in pointer.split("/")[1:]]


def _slot(parent: object, token: str):
    """The key or index by which ``parent`` holds ``token``."""
    if isinstance(parent, dict) and token in parent:
        return token
    if isinstance(parent, list) and token.isdecimal() and int(token) < len(parent):
        return int(token)
    raise PointerError(f"nothing at {token!r}")


def resolve(document: object, pointer: str) -> object:
    for token in tokens(pointer):
        document = document[_slot(document, token)]
    return document


def replace(document: object, pointer: str, value: object) -> object:
    """A copy of ``document`` with ``value`` at ``pointer``, which must exist."""

    def put(node: object, rest: list[str]) -> object:
        if not rest:
            return value
        slot = _slot(node, rest[0])
        twin = node.copy()
        twin[slot] = put(node[slot], rest[1:])
        return twin

    return put(document, tokens(pointer))


def leaves(document: object, empties: bool = True) -> Iterator[tuple[str, object]]:
    """(pointer, value) of every leaf, keys in order of code points; a stack, so depth is no limit."""
    stack = [("", document)]
    while stack:
        at, node = stack.pop()
        if isinstance(node, dict) and node:
            stack += [(f"{at}/{escape(k)}", node[k]) for k in sorted(node, reverse=True)]
        elif isinstance(node, list) and node:
            stack += [(f"{at}/{i}", node[i]) for i in range(len(node) - 1, -1, -1)]
        elif empties or not isinstance(node, (dict, list)):
            yield at or "/", node


def leaf_rows(text: Column, empties: bool = True) -> Column:
    """Array of (pointer, canonical JSON of the value) of a column of JSON texts.

    Null stays null; text that is no JSON, or is nested beyond what can be read, is one row
    without a value whose pointer is its code.
    """

    def of(text: str | None) -> list[tuple[str, str | None]] | None:
        if text is None:
            return None
        try:
            return [(p, canonical(v)) for p, v in leaves(json.loads(text), empties)]
        except (ValueError, RecursionError):
            return [("PARSE_INVALID_JSON", None)]

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(of)

    return F.pandas_udf(run, "array<struct<pointer:string,value:string>>")(text)
