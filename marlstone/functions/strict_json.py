"""Strict JSON records: one diagnostic code for each way a line can fail."""

from __future__ import annotations

import json
import math

from .jcs import canonical

#: Codes of parse failures.
CODES = (
    "PARSE_EMPTY_RECORD",
    "PARSE_RECORD_TOO_LARGE",
    "PARSE_INVALID_UTF8",
    "PARSE_INVALID_JSON",
    "PARSE_DUPLICATE_KEY",
    "PARSE_NON_FINITE_NUMBER",
    "PARSE_INVALID_UNICODE",
    "SCHEMA_EXPECTED_OBJECT",
)


class StrictError(ValueError):
    def __init__(self, code: str, message: str) -> None:
        super().__init__(message)
        self.code = code


def _pairs(items: list[tuple[str, object]]) -> dict[str, object]:
    out = dict(items)
    if len(out) != len(items):
        raise StrictError("PARSE_DUPLICATE_KEY", "a key stands twice")
    return out


def _constant(name: str) -> None:
    raise StrictError("PARSE_NON_FINITE_NUMBER", name)


def _walk(value: object):
    stack = [value]
    while stack:
        item = stack.pop()
        yield item
        if isinstance(item, dict):
            stack += [*item.keys(), *item.values()]
        elif isinstance(item, list):
            stack += item


def loads(raw: bytes) -> object:
    """The JSON value of a record's bytes, or StrictError."""
    try:
        value = json.loads(raw.decode("utf-8"), object_pairs_hook=_pairs, parse_constant=_constant)
    except UnicodeDecodeError as error:
        raise StrictError("PARSE_INVALID_UTF8", str(error)) from error
    except json.JSONDecodeError as error:
        raise StrictError("PARSE_INVALID_JSON", error.msg) from error
    except RecursionError as error:
        raise StrictError("PARSE_INVALID_JSON", "nested too deeply") from error
    items = list(_walk(value))
    if any(isinstance(x, float) and not math.isfinite(x) for x in items):
        raise StrictError("PARSE_NON_FINITE_NUMBER", "number overflows")
    if any(isinstance(x, str) and not x.isascii() and any("\ud800" <= c <= "\udfff" for c in x) for x in items):
        raise StrictError("PARSE_INVALID_UNICODE", "unpaired surrogate")
    return value


def record(raw: bytes, limit: int) -> tuple[dict | None, str | None, str | None]:
    """(object, canonical text, None) or (None, None, code) of a record without its line end."""
    if not raw:
        return None, None, "PARSE_EMPTY_RECORD"
    if len(raw) > limit:
        return None, None, "PARSE_RECORD_TOO_LARGE"
    try:
        value = loads(raw)
        if not isinstance(value, dict):
            return None, None, "SCHEMA_EXPECTED_OBJECT"
        return value, canonical(value), None
    except StrictError as error:
        return None, None, error.code
    except ValueError:
        return None, None, "PARSE_INVALID_JSON"
