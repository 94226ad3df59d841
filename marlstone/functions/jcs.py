"""Canonical JSON (RFC 8785), SHA-256 digests and prefixed stable ids.

Fixed shapes are built from column expressions (:func:`obj`, :func:`json_string`), which stay in
generated code; free JSON goes through :func:`canonical_json`, an Arrow UDF.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from json.encoder import encode_basestring

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MAX_EXACT = 2**53 - 1
_SHORT = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r", 34: '\\"', 92: "\\\\"}
_ESCAPES = {i: f"\\u{i:04x}" for i in range(32)} | _SHORT
_SURROGATE = re.compile("[\ud800-\udfff]")
_PREFIX = re.compile(r"\w+", re.ASCII)


class CanonicalError(ValueError):
    """A value outside canonical JSON."""


def _number(x: float) -> str:
    """Shortest decimal form by the ECMAScript rules."""
    if not math.isfinite(x):
        raise CanonicalError("number is not finite")
    if x == 0:
        return "0"
    mantissa, _, exponent = f"{abs(x)!r}".partition("e")
    whole, _, part = mantissa.partition(".")
    point = len(whole) + int(exponent or 0)
    digits = (whole + ("" if part == "0" else part)).lstrip("0")
    point -= len(whole + ("" if part == "0" else part)) - len(digits)
    digits = digits.rstrip("0")
    n = len(digits)
    if n <= point <= 21:
        out = digits + "0" * (point - n)
    elif 0 < point <= 21:
        out = f"{digits[:point]}.{digits[point:]}"
    elif -6 < point <= 0:
        out = f"0.{'0' * -point}{digits}"
    else:
        out = digits[0] + ("." + digits[1:] if n > 1 else "") + f"e{point - 1:+d}"
    return "-" * (x < 0) + out


def canonical(value: object) -> str:
    """Canonical text of a JSON value."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        if not value.isascii() and _SURROGATE.search(value):
            raise CanonicalError("unpaired surrogate")
        return encode_basestring(value)
    if isinstance(value, int):
        if abs(value) > _MAX_EXACT:
            raise CanonicalError("integer beyond the exact range")
        return str(value)
    if isinstance(value, float):
        return _number(value)
    if isinstance(value, list | tuple):
        return f"[{','.join(map(canonical, value))}]"
    if isinstance(value, dict):
        if not all(isinstance(k, str) for k in value):
            raise CanonicalError("key is not a string")
        keys = sorted(value) if all(map(str.isascii, value)) else sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    raise CanonicalError(f"no JSON value: {type(value).__name__}")


def digest(value: object) -> str:
    return "sha256:" + hashlib.sha256(canonical(value).encode()).hexdigest()


def stable_id(prefix: str, value: object) -> str:
    if not _PREFIX.fullmatch(prefix) or not prefix.replace("_", ""):
        raise ValueError("prefix must be letters, digits and underscores")
    return f"{prefix}_{hashlib.sha256(canonical(value).encode()).hexdigest()}"


@F.pandas_udf(T.StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    """Canonical form of JSON texts; null for text that is no canonical JSON value."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else canonical(json.loads(text))
        except ValueError:
            return None

    return values.map(one)


def json_string(value: Column) -> Column:
    """A string column as a JSON string, null as ``null``."""
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for code in (34, 8, 9, 10, 12, 13):
        out = F.replace(out, F.lit(chr(code)), F.lit(_ESCAPES[code]))
    rare = out
    for code in range(32):
        if code not in _SHORT:
            rare = F.replace(rare, F.lit(chr(code)), F.lit(_ESCAPES[code]))
    full = F.when(value.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), rare).otherwise(out)
    return F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), full, F.lit('"')))


def obj(**fields: Column) -> Column:
    """A JSON object of columns that are JSON text already, keys in canonical order."""
    parts: list[Column] = []
    for i, key in enumerate(sorted(fields)):
        parts += [F.lit(("," if i else "{") + canonical(key) + ":"), fields[key]]
    return F.concat(*parts, F.lit("}"))


def arr(items: Column) -> Column:
    """A JSON array of an array column of JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def sha(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def id_of(prefix: str, text: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.sha2(text, 256))
