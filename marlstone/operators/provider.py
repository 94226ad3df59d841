"""Provider runs on recorded data: usage, attempts, preflight, budgets, claims and results.

Nothing here sends anything.  Responses are rows of a table, keyed by request id; a request
without a row has no response.

Defined results: null or unreadable JSON gives no usage; a null status matches no rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jcs import id_of, json_string, obj

#: Versions in ids, and limits of a connection.
ATTEMPT_VERSION = "provider-attempt-0.1.0"
MAX_TIMEOUT_SECONDS = 120
MAX_RESPONSE_BYTES = 8 << 20
RETRY_STATUSES = (402, 429)

#: By response style, where its counters stand: input, output, cached input.
COUNTERS = {
    "chat": ("$.usage.prompt_tokens", "$.usage.completion_tokens", "$.usage.prompt_cache_hit_tokens"),
    "responses": ("$.usage.input_tokens", "$.usage.output_tokens", "$.usage.input_tokens_details.cached_tokens"),
}


def _counter(body: Column, path: str) -> Column:
    """A counter of a JSON text: a plain integer of 0 or more, else null (text, fractions and booleans are none)."""
    found = F.variant_get(F.try_parse_json(body), path, "string")
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json(body), path, "variant"))
    return F.when((kind == "BIGINT") & found.rlike("^[0-9]+$"), found.try_cast("long"))


def usage(responses: DataFrame, body: str, style: str) -> DataFrame:
    """``responses`` with input_tokens, cached_tokens, output_tokens; all null where the counters do not hold.

    ``style`` is a column name with a key of COUNTERS.
    """
    counters = {name: F.lit(None).cast("long") for name in ("n_in", "n_out", "n_cached")}
    for kind, paths in COUNTERS.items():
        for name, path in zip(counters, paths, strict=True):
            counters[name] = F.when(F.col(style) == kind, _counter(F.col(body), path)).otherwise(counters[name])
    read = responses.withColumns(counters).withColumn("n_cached", F.coalesce("n_cached", F.lit(0).cast("long")))
    holds = F.col("n_in").isNotNull() & F.col("n_out").isNotNull() & (F.col("n_cached") <= F.col("n_in"))
    out = {"input_tokens": "n_in", "cached_tokens": "n_cached", "output_tokens": "n_out"}
    return read.withColumns({name: F.when(holds, F.col(c)) for name, c in out.items()}).drop(*counters)


def attempt_id(operation: Column, provider: Column, model: Column, endpoint: Column, request_sha256: Column) -> Column:
    """One request has one id, however often it is tried."""
    body = obj(
        schema_version=F.lit(f'"{ATTEMPT_VERSION}"'), operation=json_string(operation), provider=json_string(provider),
        model=json_string(model), endpoint=json_string(endpoint), request_sha256=json_string(request_sha256),
    )
    return id_of("pvattempt", body)


def attempt_faults(attempts: DataFrame) -> DataFrame:
    """``attempts`` (outcome, allowed, response_sha256, failure_code, http_status, disposition) with an array of faults."""
    outcome, answered, failed = F.col("outcome"), F.col("response_sha256").isNotNull(), F.col("failure_code").isNotNull()
    blocked, done = outcome == "preflight_blocked", outcome == "succeeded"
    whole = F.col("allowed") & answered & ~failed & F.col("http_status").isNull() & (F.col("disposition") == "not_applicable")
    rules = (
        (blocked & (F.col("allowed") | answered), "blocked_with_response"),
        (blocked & ~F.coalesce(F.col("failure_code") == "preflight_blocked", F.lit(False)), "blocked_without_its_code"),
        (done & ~F.coalesce(whole, F.lit(False)), "success_inconsistent"),
        (~blocked & ~done & answered & ~F.col("allowed"), "response_though_blocked"),
        ((outcome == "failed") & ~failed, "failure_without_code"),
        (
            F.col("http_status").isNotNull() & ~F.coalesce(F.col("failure_code").isin("http_transient", "http_permanent"), F.lit(False)),
            "status_without_http_failure",
        ),
    )
    return attempts.withColumn("faults", F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in rules))))


def retryable(outcome: Column, http_status: Column, asked: tuple[int, ...] = RETRY_STATUSES) -> Column:
    """Failed attempts whose HTTP status is one of those asked for, of the two that may be."""
    return (outcome == "failed") & F.coalesce(http_status.isin(*(s for s in asked if s in RETRY_STATUSES)), F.lit(False))


def preflight(payload_sha256: Column, rules: Column, providers_enabled: bool, egress_enabled: bool, live: bool = True) -> Column:
    """Struct payload_sha256, rules, allowed: what a scan found and the gates that are shut.

    ``rules`` is the array of rule ids that the scan of endpoint and payload gave.  Offline
    nothing is ever allowed.
    """
    gates = [(not live, "policy.offline_configuration"), (live and not providers_enabled, "policy.providers_disabled")]
    gates.append((live and not egress_enabled, "policy.network_egress_disabled"))
    shut = F.array(*(F.lit(name) for closed, name in gates if closed)).cast("array<string>")
    every = F.concat(F.coalesce(rules, F.array().cast("array<string>")), shut)
    return F.struct(payload_sha256.alias("payload_sha256"), every.alias("rules"), (F.size(every) == 0).alias("allowed"))


def connection_faults(endpoint: Column, timeout_seconds: Column, max_response_bytes: Column, hosts: dict[str, str], provider: Column) -> Column:
    """Faults of a connection's settings: https, the provider's one host and path, limits."""
    allowed = F.create_map(*(F.lit(x) for pair in hosts.items() for x in pair))
    rules = (
        (~F.coalesce(endpoint.startswith("https://"), F.lit(False)), "not_https"),
        (~F.coalesce(endpoint == allowed[provider], F.lit(False)), "endpoint_not_of_provider"),
        (~F.coalesce(timeout_seconds.between(1, MAX_TIMEOUT_SECONDS), F.lit(False)), "timeout_out_of_range"),
        (~F.coalesce(max_response_bytes.between(1, MAX_RESPONSE_BYTES), F.lit(False)), "response_limit_out_of_range"),
    )
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in rules)))


def total_cost(lines: DataFrame, usd: str = "estimated_usd") -> DataFrame:
    """One row: the sum of the lines' cost, lines without one as 0."""
    return lines.agg(F.coalesce(F.sum(usd), F.lit(0).cast("decimal(38,12)")).alias("total_usd"))


def budget_states(spent: DataFrame, budgets: DataFrame) -> DataFrame:
    """(model, n_tokens, budget, state): the least budget of a model, warned from 80 %, exceeded from 100 %."""
    least = budgets.groupBy("model").agg(F.min("budget").cast("long").alias("budget"))
    used = spent.groupBy("model").agg(F.sum("n_tokens").alias("n_tokens"))
    both = used.join(F.broadcast(least), "model", "left")  # one row for each configured model
    share = F.col("n_tokens") * 100
    state = F.when(share >= F.col("budget") * 100, "exceeded").when(share >= F.col("budget") * 80, "warning").otherwise("within")
    return both.withColumn("state", F.when(F.col("budget").isNull(), F.lit("no_budget")).otherwise(state))


def route_counts(results: DataFrame, routes: str = "routes") -> DataFrame:
    """One row: results of the first route alone, and of the first and the second."""
    n = F.size(routes)
    return results.agg(F.count_if(n >= 1).alias("n_primary"), F.count_if(n == 2).alias("n_fallback"))


def recorded(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """``requests`` (request_id, segment_ids) with their recorded response and its fault.

    responses: request_id, segments (array of struct segment_id, target_text).  The answer must
    hold exactly the segments that were asked for, each once, none without text.
    """
    counted = responses.groupBy("request_id").agg(F.count("*").alias("n"), F.min("segments").alias("segments"))
    joined = requests.join(counted, "request_id", "left")
    got = F.col("segments.segment_id")
    fault = (
        F.when(F.col("n").isNull(), "no_recorded_response")
        .when(F.col("n") > 1, "several_recorded_responses")
        .when(F.size(F.array_distinct(got)) < F.size(got), "segment_twice")
        .when(F.size(F.array_except("segment_ids", got)) > 0, "segment_missing")
        .when(F.size(F.array_except(got, "segment_ids")) > 0, "segment_not_asked")
        .when(F.exists("segments", lambda s: F.coalesce(s["target_text"], F.lit("")) == ""), "empty_target")
    )
    return joined.withColumn("fault", fault).drop("n")


def answered(requests: DataFrame, translate: Callable[[str], str], column: str = "request") -> DataFrame:
    """``requests`` with answer and failure of a caller's own ``translate``, called once for each row in the executors.

    What it raises is a failure of its row by the exception's name; texts never go into it.
    """
    fields = [f.name for f in requests.schema.fields]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            answers, failures = [], []
            for request in part[column]:
                try:
                    answers.append(translate(request))
                    failures.append(None)
                except Exception as error:  # noqa: BLE001  a caller's code may raise anything; the row says what
                    answers.append(None)
                    failures.append(type(error).__name__)
            yield part.assign(answer=answers, failure=failures)[[*fields, "answer", "failure"]]

    schema = T.StructType([*requests.schema.fields, T.StructField("answer", T.StringType()), T.StructField("failure", T.StringType())])
    return requests.mapInPandas(run, schema)


def pending(jobs: DataFrame, done: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """``jobs`` with state: done, manual_recovery (claimed without a result: it may have been sent) or to_send."""
    seen = lambda rows, name: rows.select(key).distinct().withColumn(name, F.lit(True))
    both = jobs.join(seen(done, "_done"), key, "left").join(seen(claims, "_claimed"), key, "left")
    state = F.when(F.col("_done"), "done").when(F.col("_claimed"), "manual_recovery").otherwise("to_send")
    return both.withColumn("state", state).drop("_done", "_claimed")


def episode_states(episodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """(episode_id, status, n_leaves): no_translatable_segments, research_needed, incomplete or translated.

    episodes: episode_id, n_segments; leaves: episode_id, segment_id, status.
    """
    found = leaves.groupBy("episode_id").agg(
        F.count_distinct("segment_id").alias("n_leaves"), F.bool_or(F.col("status") == "research_needed").alias("open")
    )
    both = episodes.join(found, "episode_id", "left").withColumn("n_leaves", F.coalesce("n_leaves", F.lit(0)))
    status = (
        F.when(F.col("n_segments") == 0, "no_translatable_segments")
        .when(F.col("n_leaves") < F.col("n_segments"), "incomplete")
        .when(F.col("open"), "research_needed")
        .otherwise("translated")
    )
    return both.select("episode_id", status.alias("status"), "n_leaves")


def judge_inputs(episodes: DataFrame, units: DataFrame, judged: DataFrame) -> DataFrame:
    """Units of translated episodes without a judgement yet: what a run that is taken up again still has to judge."""
    ready = episodes.where("status = 'translated'").select("episode_id")
    return units.join(ready, "episode_id", "left_semi").join(judged.select("unit_id"), "unit_id", "left_anti")


def recovery_selection(results: DataFrame, attempts: DataFrame, asked: tuple[int, ...] = RETRY_STATUSES) -> DataFrame:
    """Episodes whose last route failed with a retryable attempt.

    results: episode_id, status, routes (array of struct route, status); attempts: episode_id,
    route, outcome, http_status.
    """
    last = F.element_at("routes", -1)
    failed = results.where("status = 'needs_review'").where(last["status"] == "failed").select("episode_id", last["route"].alias("route"))
    tried = attempts.where(retryable(F.col("outcome"), F.col("http_status"), asked)).select("episode_id", "route").distinct()
    return failed.join(tried, ["episode_id", "route"], "left_semi").select("episode_id")
