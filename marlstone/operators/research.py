"""Terms that need research, and the limits of the requests that look for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jcs import id_of, json_string, obj

#: An upper-case abbreviation, what one episode may spend, and the version in ids.
ABBREVIATION = r"[A-Z][A-Z0-9]{1,9}"
MAX_QUERIES, MAX_SOURCES, MAX_SECONDS = 3, 5, 60
RISK_VERSION = "terminology-risk-0.1.0"

#: Word edges by Unicode letters, numbers and underscore; a combining mark is an edge.  The digit
#: beyond the BMP, itself a number, makes Java look behind by code points.
_PATTERN = "(?<![\\p{L}\\p{N}_\U0001d7ff])" + ABBREVIATION + "(?![\\p{L}\\p{N}_])"


def abbreviations(text: Column) -> Column:
    """Sorted distinct upper-case abbreviations of a text; null counts as empty."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_PATTERN), F.lit(0))))


def risks(inputs: DataFrame) -> DataFrame:
    """(risk_id, segment_id, path, term, trigger) of inputs (segment_id, path, text, policy_state).

    A text that no policy settles is a risk as a whole; each abbreviation is one of its own.
    """
    term = lambda value, trigger: F.struct(value.alias("term"), F.lit(trigger).alias("trigger"))
    whole = F.when(F.col("policy_state") == "manual_policy_required", F.array(term(F.col("text"), "field_policy_unresolved")))
    short = F.transform(abbreviations(F.col("text")), lambda x: term(x, "uppercase_abbreviation"))
    each = inputs.select("segment_id", "path", F.explode(F.concat(F.coalesce(whole, F.array().cast("array<struct<term:string,trigger:string>>")), short)).alias("t"))
    rows = each.select("segment_id", "path", "t.*")
    body = obj(
        schema_version=F.lit(f'"{RISK_VERSION}"'), segment_id=json_string(F.col("segment_id")), path=json_string(F.col("path")),
        term=json_string(F.col("term")), trigger=json_string(F.col("trigger")), disposition=F.lit('"needs_research"'),
    )
    return rows.select(id_of("risk", body).alias("risk_id"), "segment_id", "path", "term", "trigger")


def request_faults(endpoint_rule: Column, queries: Column, sources: Column, seconds: Column) -> Column:
    """Faults of a request; ``endpoint_rule`` is null where the address is public https."""
    rules = (
        (endpoint_rule.isNotNull(), "address_not_public_https"),
        (~F.coalesce(queries.between(1, MAX_QUERIES), F.lit(False)), "query_budget"),
        (~F.coalesce(sources.between(1, MAX_SOURCES), F.lit(False)), "source_budget"),
        (~F.coalesce(seconds.between(0, MAX_SECONDS), F.lit(False)), "time_budget"),
    )
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in rules)))


def resolution_faults(status: Column, targets: Column) -> Column:
    """The fault of a resolution's status against its candidates' targets, null for none."""
    n, different = F.size(targets), F.size(F.array_distinct(targets))
    return (
        F.when((status == "resolved") & (n != 1), "resolved_needs_one_candidate")
        .when((status == "conflicting") & (different < 2), "conflicting_needs_two_targets")
        .when((status == "unresolved") & (n > 0), "unresolved_with_candidates")
    )
