"""Secrets, personal data, local paths and private endpoints in text.

The rules are a table.  Their spans are found by the JVM's regular expressions, in code
points; only the addresses among them go to Python, to be taken apart.  Where findings
overlap, the earlier wins, then the longer, then the rule's name; what is left can be
redacted.

The patterns are written for a matcher whose letters, digits, blanks and word edges are
those of Unicode; ``jvm_pattern`` spells that out for the JVM.  The one known difference: a
capital I with a dot does not count as an ASCII letter where case is ignored.

Defined results: null text has no findings and stays null when redacted.
"""

from __future__ import annotations

import ipaddress
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans

# Name, category, pattern, whether case is ignored.
RULES = (
    ("secret.private_key", "secret", r"-----BEGIN(?: [A-Z]+)? PRIVATE KEY-----[\s\S]*?-----END(?: [A-Z]+)? PRIVATE KEY-----", True),
    (
        "secret.assignment",
        "secret",
        r"\b(?:api[_-]?key|access[_-]?token|auth(?:orization)?|secret|password|passwd|token)\b\s*[:=]\s*(?:[\"']?)[^\s\"']{4,}",
        True,
    ),
    ("secret.bearer", "secret", r"\bBearer\s+[A-Za-z0-9._~+/=-]{8,}", True),
    ("secret.openai_style", "secret", r"\bsk-[A-Za-z0-9_-]{16,}\b", False),
    ("secret.google_api_key", "secret", r"\bAIza[A-Za-z0-9_-]{20,}\b", False),
    ("secret.aws_access_key", "secret", r"\bAKIA[0-9A-Z]{16}\b", False),
    ("pii.email", "pii", r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", True),
    ("pii.phone", "pii", r"(?<!\w)(?:\+?90[\s.-]?)?(?:0?5\d{2}[\s.-]?\d{3}[\s.-]?\d{2}[\s.-]?\d{2})(?!\w)", False),
    ("pii.tckn", "pii", r"(?<!\d)\d{11}(?!\d)", False),
    ("path.file_uri", "local_path", r"\bfile://[^\s\"']+", True),
    ("path.windows_drive", "local_path", r"(?<![\w:])[A-Za-z]:[\\/][^\s\"']*", False),
    ("path.unc", "local_path", r"(?<!:)\\\\[^\s\"']+|(?<!:)//[^\s\"']+", False),
    ("path.unix_absolute", "local_path", r"(?<![\w:])/(?:[^/\s\"']+/?)+", False),
    ("path.home", "local_path", r"(?<!\w)~/[^\s\"']+", False),
)
URL = r"https?://[^\s\"']+"
LOCAL_NAMES = ("localhost", "localhost.localdomain")
LOCAL_ENDS = (".localhost", ".local", ".internal")
ADDRESS_KINDS = ("is_private", "is_loopback", "is_link_local", "is_reserved", "is_unspecified", "is_multicast")
# End of fixed values.

SECRETS = {name: (pattern, ignored) for name, category, pattern, ignored in RULES if category == "secret"}

#: Word characters as letters, numbers and underscore.  The digit beyond the BMP, itself a number,
#: makes the JVM look behind by code points.
_WORD = "\\p{L}\\p{N}_\U0001d7ff"
#: Control characters that are blanks for the patterns' matcher only.
_BLANKS = "\x1c\x1d\x1e\x1f"


def jvm_pattern(pattern: str, ignore_case: bool = False) -> str:
    """A pattern with Unicode's words, digits, blanks and edges for the JVM."""
    edge = f"(?:(?<![{_WORD}])(?=[{_WORD}])|(?<=[{_WORD}])(?![{_WORD}]))"
    body = pattern.replace(r"[\w", f"[{_WORD}").replace(r"\w", f"[{_WORD}]").replace(r"\b", edge).replace(r"\d", r"\p{Nd}")
    return ("(?iuU)" if ignore_case else "(?U)") + body


def identity_number(digits: Column) -> Column:
    """Whether 11 digits hold the checksum of a national identity number."""
    d = [F.substring(digits, i, 1).try_cast("int") for i in range(1, 12)]
    odd, even = sum(d[0:9:2], F.lit(0)), sum(d[1:8:2], F.lit(0))
    holds = (d[0] != 0) & (d[9] == F.pmod(odd * 7 - even, F.lit(10))) & (d[10] == F.pmod(sum(d[:10], F.lit(0)), F.lit(10)))
    return F.coalesce(holds, F.lit(False))


# -- endpoints -----------------------------------------------------------------------
class _Address:
    """An address taken apart; nothing is resolved or contacted."""

    def __init__(self, url: str) -> None:
        try:
            self.parts = urlsplit(url)
            self.host = (self.parts.hostname or "").rstrip(".").casefold()
            self.web = self.parts.scheme in ("http", "https") and bool(self.parts.hostname)
        except ValueError:
            self.parts, self.host, self.web = None, "", False

    def numbered(self) -> bool:
        try:
            number = ipaddress.ip_address(self.host)
        except ValueError:
            return False
        return any(getattr(number, kind) for kind in ADDRESS_KINDS)


#: What an address must not be, in order; the third only where https is asked for.
ENDPOINT_RULES = {
    "endpoint.invalid_url": lambda a: not a.web,
    "endpoint.embedded_credentials": lambda a: a.parts.username is not None or a.parts.password is not None,
    "endpoint.non_https": lambda a: a.parts.scheme == "http",
    "endpoint.private_hostname": lambda a: a.host in LOCAL_NAMES or a.host.endswith(LOCAL_ENDS),
    "endpoint.private_address": _Address.numbered,
}


def endpoint_rule(url: str, need_https: bool = True) -> str | None:
    """The first rule that an address breaks."""
    address = _Address(url)
    asked = (name for name in ENDPOINT_RULES if need_https or name != "endpoint.non_https")
    return next((name for name in asked if ENDPOINT_RULES[name](address)), None)


def endpoint_rules(urls: Column, need_https: bool = False) -> Column:
    """The rules that an array of addresses breaks, null for none, each different address once a batch."""

    @F.pandas_udf("array<string>")
    def broken(batch: pd.Series) -> pd.Series:
        known = {url: endpoint_rule(url, need_https) for url in {u for urls in batch for u in urls}}
        return batch.map(lambda urls: [known[u] for u in urls])

    return broken(urls)


# -- findings ------------------------------------------------------------------------
def _finding(span: Column, rule: Column, category: str, redactable: bool) -> Column:
    return F.struct(
        span["start"].alias("start"),
        (-span["end"]).alias("back"),
        rule.alias("rule_id"),
        F.lit(category).alias("category"),
        F.lit(redactable).alias("redactable"),
    )


def _apart(findings: Column) -> Column:
    """Findings in order without those that begin inside one that was taken."""
    one = "struct<rule_id:string,category:string,start:int,end:int,redactable:boolean>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{one}>").alias("taken"))

    def step(acc: Column, x: Column) -> Column:
        item = F.struct(
            x["rule_id"].alias("rule_id"), x["category"].alias("category"), x["start"].alias("start"), (-x["back"]).alias("end"), x["redactable"].alias("redactable")
        )
        grown = F.struct((-x["back"]).alias("at"), F.concat(acc["taken"], F.array(item)).alias("taken"))
        return F.when(x["start"] >= acc["at"], grown).otherwise(acc).cast(f"struct<at:int,taken:array<{one}>>")

    return F.aggregate(F.array_sort(findings), start, step, lambda acc: acc["taken"])


def scan(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``df`` with an array of struct rule_id, category, start, end, redactable of its text."""
    df = df.withColumn("_plain", F.translate(F.coalesce(F.col(text), F.lit("")), _BLANKS, "\x85" * len(_BLANKS)))
    plain = F.col("_plain")
    # the addresses have a column of their own, as only they leave the JVM
    urls = df.withColumn("_urls", _where("url", plain, spans.found(plain, "url", jvm_pattern(URL, True))))
    known = urls.withColumn("_broken", endpoint_rules(F.transform("_urls", lambda s: s["value"])))
    parts = []
    for name, category, pattern, ignored in RULES:
        check = identity_number if name == "pii.tckn" else None
        own = _where(name, plain, spans.found(plain, name, jvm_pattern(pattern, ignored), check))
        parts.append(_named(own, category))
    private = F.zip_with("_urls", "_broken", lambda s, rule: _finding(s, rule, "private_endpoint", False))
    every = F.concat(*parts, F.filter(private, lambda f: f["rule_id"].isNotNull()))
    return known.withColumn(out, _apart(every)).drop("_plain", "_urls", "_broken")


#: What must stand in a text for a rule to match at all.
_HINTS = {
    "secret.private_key": "-----", "secret.openai_style": "sk-", "secret.google_api_key": "AIza", "secret.aws_access_key": "AKIA", "pii.email": "@",
    "path.file_uri": "://", "path.windows_drive": ":", "path.unix_absolute": "/", "path.home": "~/", "url": "://",
}


def _where(name: str, text: Column, found: Column) -> Column:
    hint = _HINTS.get(name)
    return F.when(F.contains(text, F.lit(hint)), found).otherwise(F.array().cast(spans.SPANS)) if hint else found


def _named(found: Column, category: str) -> Column:
    return F.transform(found, lambda s: _finding(s, s["name"], category, True))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every finding in its text as [REDACTED:<CATEGORY>]."""
    label = lambda s: F.concat(F.lit("[REDACTED:"), F.upper(s["category"]), F.lit("]"))
    found = scan(df, text, "_found")
    clean = spans.replaced(F.col(text), F.col("_found"), label)
    return found.withColumn(text, F.when(F.col(text).isNotNull(), clean)).select(*df.columns)
