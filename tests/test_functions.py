import random
import re
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from marlstone.functions import jcs, scan, strict_json


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (1.0, "1"), (1e21, "1e+21"), (-0.0, "0"), (1e-7, "1e-7"), (0.000001, "0.000001"), (123456789012345680000.0, "123456789012345680000"),
        (1.5, "1.5"), (-2.25e-9, "-2.25e-9"), (100.0, "100"), (True, "true"), (None, "null"),
        ("\b\t\n\f\r\"\\\x1f", '"\\b\\t\\n\\f\\r\\"\\\\\\u001f"'), ({"b": 1, "a": [None]}, '{"a":[null],"b":1}'),
    ],
)
def test_canonical(value, text):
    assert jcs.canonical(value) == text


@given(st.dictionaries(st.text(), st.integers(-1000, 1000)))
def test_key_order_never_counts(value):
    assert jcs.digest(value) == jcs.digest(dict(reversed(value.items())))


def test_canonical_rejects():
    for bad in (float("nan"), float("inf"), 2**53, {1: 2}, object(), "\ud800"):
        with pytest.raises(jcs.CanonicalError):
            jcs.canonical(bad)
    with pytest.raises(ValueError):
        jcs.stable_id("", {})


@pytest.mark.parametrize(
    ("raw", "code"),
    [
        (b"", "PARSE_EMPTY_RECORD"), (b'{"a":1,"a":2}', "PARSE_DUPLICATE_KEY"), (b'{"a":NaN}', "PARSE_NON_FINITE_NUMBER"),
        (b'{"a":1e999}', "PARSE_NON_FINITE_NUMBER"), (b'"\xff"', "PARSE_INVALID_UTF8"), (b"[]", "SCHEMA_EXPECTED_OBJECT"),
        (b"{broken}", "PARSE_INVALID_JSON"), (b'{"a":"\\ud800"}', "PARSE_INVALID_UNICODE"), (b'{"a":"' + b"x" * 99 + b'"}', "PARSE_RECORD_TOO_LARGE"),
        (b'{"a":1}', None),
    ],
)
def test_strict_codes(raw, code):
    assert strict_json.record(raw, 64)[2] == code


def scan_by_hand(text):
    """Findings from the definition: every rule's matches, then those that do not begin inside one taken before."""
    found = []
    for name, category, pattern, ignored in scan.RULES:
        for m in re.finditer(pattern, text, re.IGNORECASE if ignored else 0):
            digits = [int(c) for c in m[0]] if name == "pii.tckn" else []
            if digits and not (
                digits[0] and digits[9] == (7 * sum(digits[0:9:2]) - sum(digits[1:8:2])) % 10 and digits[10] == sum(digits[:10]) % 10
            ):
                continue
            found.append((m.start(), -m.end(), name, category, True))
    for m in re.finditer(scan.URL, text, re.IGNORECASE):
        if rule := scan.endpoint_rule(m[0], need_https=False):
            found.append((m.start(), -m.end(), rule, "private_endpoint", False))
    out = []
    for start, back, *rest in sorted(found):
        if not out or start >= out[-1][3]:
            out.append((rest[0], rest[1], start, -back, rest[2]))
    return out


def test_scan(spark):
    rng = random.Random(4)
    parts = ["a@b.com", "token = abcd1234", "/etc/passwd", "http://localhost/x", "10000000146", "0532 123 45 67", "C:\\x y", "\\\\srv\\s", "~/z", "file:///q", "é", "ß🙂", " ", "\n",
             "sk-" + "a" * 20, "AKIA" + "B" * 16, "-----BEGIN PRIVATE KEY-----x-----END PRIVATE KEY-----", "Bearer abcdefgh.1", "https://u:p@h.org/", "http://10.0.0.8:80", "\x1c", ":", "//", "_", "x"]
    texts = ["mail a@b.com token = abcd1234 at /etc/passwd and http://localhost/x, id 10000000146", "", None]
    texts += ["".join(rng.choice(parts) + rng.choice(["", " ", " ", ","]) for _ in range(rng.randint(1, 14))) for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    for r in scan.scan(rows).collect():
        assert [tuple(s) for s in r.spans] == scan_by_hand(r.text or ""), r.text
    for r in scan.redact(rows).collect():
        text, at, out = texts[r.n], 0, []
        for _, category, start, end, _ in scan_by_hand(text or ""):
            out += [text[at:start], f"[REDACTED:{category.upper()}]"]
            at = end
        assert r.text == (None if text is None else "".join(out) + text[at:])


def test_endpoint_rules():
    assert scan.endpoint_rule("https://u:p@x.org") == "endpoint.embedded_credentials"
    assert scan.endpoint_rule("http://x.org") == "endpoint.non_https"
    assert scan.endpoint_rule("https://10.0.0.1") == "endpoint.private_address"
    assert scan.endpoint_rule("https://a.internal.") == "endpoint.private_hostname"
    assert scan.endpoint_rule("https://[bad") == scan.endpoint_rule("ftp://x") == "endpoint.invalid_url"
    assert scan.endpoint_rule("https://x.org") is None


def test_json_columns_match_canonical(spark):
    from pyspark.sql import functions as F

    texts = ["a\"b\\c\n\t\r\b\f\x01\x1f", "é🙂", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(jcs.sha(jcs.obj(k=jcs.json_string(F.col("t")))).alias("s"))
    assert [r.s for r in rows.collect()] == [jcs.digest({"k": t}) for t in texts]
    assert hashlib.sha256(b"x").hexdigest() == spark.range(1).select(F.sha2(F.lit("x"), 256)).first()[0]
