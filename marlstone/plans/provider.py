"""Registered queries of provider runs on recorded data, of bronze ingestion and of publication checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import spans
from ..functions.jcs import json_string, obj, sha
from ..operators import provider
from ..operators.common import shared_folder
from ..sources import jsonl, publish
from .reference import ORACLES, QUERIES, js, query, table
from .review import _listed

__all__ = ["ORACLES", "QUERIES"]


@query("""
    WITH e AS (SELECT event_id, event_id % 3 AS k, event_id % 50 AS a, event_id % 70 AS b, event_id % 60 AS c, event_type = 'error' AS torn, event_type = 'view' AS worded FROM events),
    u AS (SELECT event_id, k, a, b, CASE WHEN k = 1 AND c % 2 = 0 THEN 0 ELSE c END AS c, torn, worded FROM e)
    SELECT event_id, CASE WHEN ok THEN a END AS input_tokens, CASE WHEN ok THEN c END AS cached_tokens, CASE WHEN ok THEN b END AS output_tokens
    FROM (SELECT *, k < 2 AND NOT torn AND NOT worded AND c <= a AS ok FROM u)""")
def usage_counters(spark, sf_dir):
    """Responses of two styles and an unknown one; some are torn, some count in words, some cache more than they read."""
    number, kind = F.col("event_id"), F.col("event_type")
    text = lambda x: x.cast("string")
    a = F.when(kind == "view", '"many"').otherwise(text(number % 50))
    chat = obj(usage=obj(prompt_tokens=a, completion_tokens=text(number % 70), prompt_cache_hit_tokens=text(number % 60)))
    details = F.when(number % 60 % 2 == 0, F.lit("{}")).otherwise(obj(cached_tokens=text(number % 60)))
    answers = obj(usage=obj(input_tokens=a, output_tokens=text(number % 70), input_tokens_details=details))
    body = F.when(number % 3 == 1, answers).otherwise(chat)
    style = F.when(number % 3 == 0, "chat").when(number % 3 == 1, "responses").otherwise("other")
    rows = table(spark, sf_dir, "events").select("event_id", style.alias("style"), F.when(kind == "error", F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body).alias("body"))
    return provider.usage(rows, "body", "style").select("event_id", "input_tokens", "cached_tokens", "output_tokens")


@query(f"""
    WITH a AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'preflight_blocked' ELSE 'succeeded' END AS o, event_id % 5 > 0 AS allowed,
                      event_id % 7 > 1 AS answered, CASE event_id % 4 WHEN 0 THEN 'http_transient' WHEN 1 THEN 'preflight_blocked' END AS f,
                      CASE WHEN event_id % 6 = 0 THEN 429 WHEN event_id % 6 = 1 THEN 500 END AS status, event_id % 9 > 0 AS plain FROM events)
    SELECT event_id, {_listed(
        ("o = 'preflight_blocked' AND (allowed OR answered)", "blocked_with_response"),
        ("o = 'preflight_blocked' AND f IS DISTINCT FROM 'preflight_blocked'", "blocked_without_its_code"),
        ("o = 'succeeded' AND NOT (allowed AND answered AND f IS NULL AND status IS NULL AND plain)", "success_inconsistent"),
        ("o = 'failed' AND answered AND NOT allowed", "response_though_blocked"),
        ("o = 'failed' AND f IS NULL", "failure_without_code"),
        ("status IS NOT NULL AND f IS DISTINCT FROM 'http_transient'", "status_without_http_failure"),
    )} AS faults, o = 'failed' AND coalesce(status = 429, false) AS retryable FROM a""")
def attempt_rules(spark, sf_dir):
    """Attempts whose outcome, gate, answer, code and status come from different residues."""
    number, kind = F.col("event_id"), F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", "failed").when(kind == "view", "preflight_blocked").otherwise("succeeded").alias("outcome"),
        (number % 5 > 0).alias("allowed"),
        F.when(number % 7 > 1, "sha256:x").alias("response_sha256"),
        F.when(number % 4 == 0, "http_transient").when(number % 4 == 1, "preflight_blocked").alias("failure_code"),
        F.when(number % 6 == 0, 429).when(number % 6 == 1, 500).alias("http_status"),
        F.when(number % 9 > 0, "not_applicable").otherwise("do_not_retry").alias("disposition"),
    )
    made = provider.attempt_faults(rows)
    return made.select("event_id", F.array_join("faults", ",").alias("faults"), provider.retryable(F.col("outcome"), F.col("http_status")).alias("retryable"))


@query("""
    SELECT event_id, 'pvattempt_' || sha256('{"endpoint":"https://api.example.org/v1","model":"m' || event_id % 4 || '","operation":"' || event_type
               || '","provider":"p","request_sha256":"sha256:' || sha256(props) || '","schema_version":"provider-attempt-0.1.0"}') AS attempt_id FROM events""")
def attempt_ids(spark, sf_dir):
    model = F.concat(F.lit("m"), (F.col("event_id") % 4).cast("string"))
    made = provider.attempt_id(F.col("event_type"), F.lit("p"), model, F.lit("https://api.example.org/v1"), sha(F.col("props")))
    return table(spark, sf_dir, "events").select("event_id", made.alias("attempt_id"))


@query("""
    WITH r AS (SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '\\bsk-[A-Za-z0-9_-]{16,}\\b') THEN 'secret.openai_style' END,
                                           CASE WHEN regexp_matches(text, '\\bAKIA[0-9A-Z]{16}\\b') THEN 'secret.aws_access_key' END], lambda x: x IS NOT NULL) AS rules FROM documents)
    SELECT doc_id, 'closed' AS gate, array_to_string(rules || ['policy.providers_disabled', 'policy.network_egress_disabled'], ',') AS rules, false AS allowed FROM r
    UNION ALL SELECT doc_id, 'open', array_to_string(rules, ','), len(rules) = 0 FROM r
    UNION ALL SELECT doc_id, 'offline', array_to_string(rules || ['policy.offline_configuration'], ','), false FROM r""")
def preflight_gates(spark, sf_dir):
    """What two rules find in every text, with the gates shut, open and offline."""
    from ..functions.scan import SECRETS, jvm_pattern

    names = ("secret.openai_style", "secret.aws_access_key")
    rules = F.array_compact(F.array(*(F.when(F.col("text").rlike(jvm_pattern(*SECRETS[n])), n) for n in names)))
    docs = table(spark, sf_dir, "documents").select("doc_id", sha(F.col("text")).alias("payload"), rules.alias("rules"))
    out = None
    for gate, (enabled, live) in {"closed": (False, True), "open": (True, True), "offline": (True, False)}.items():
        made = docs.select("doc_id", F.lit(gate).alias("gate"), provider.preflight(F.col("payload"), F.col("rules"), enabled, enabled, live).alias("d"))
        part = made.select("doc_id", "gate", F.array_join("d.rules", ",").alias("rules"), F.col("d.allowed").alias("allowed"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""
    WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'http' ELSE 'https' END || '://api.' || event_type || '.example.org' || CASE WHEN event_id % 7 = 0 THEN '/other' ELSE '/v1' END AS url,
                      event_id % 130 AS t, event_id * 997 AS b, event_id % 5 = 0 AS plain, event_id % 7 = 0 OR event_id % 5 = 0 OR event_type NOT IN ('view', 'click') AS foreign_ FROM events)
    SELECT event_id, {_listed(("plain", "not_https"), ("foreign_", "endpoint_not_of_provider"), ("t NOT BETWEEN 1 AND 120", "timeout_out_of_range"),
                             ("b NOT BETWEEN 1 AND 8388608", "response_limit_out_of_range"))} AS faults FROM e""")
def connection_settings(spark, sf_dir):
    number = F.col("event_id")
    scheme, path = F.when(number % 5 == 0, "http").otherwise("https"), F.when(number % 7 == 0, "/other").otherwise("/v1")
    url = F.concat(scheme, F.lit("://api."), "event_type", F.lit(".example.org"), path)
    hosts = {k: f"https://api.{k}.example.org/v1" for k in ("view", "click")}
    faults = provider.connection_faults(url, number % 130, number * 997, hosts, F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(faults, ",").alias("faults"))


@query("""
    WITH u AS (SELECT event_type AS model, sum(event_id % 100) AS n_tokens FROM events GROUP BY 1),
    b AS (SELECT * FROM (VALUES ('view', 1), ('click', 100000000), ('click', 200000000), ('signup', 120000)) AS t(model, budget)),
    m AS (SELECT model, CAST(min(budget) AS BIGINT) AS budget FROM b GROUP BY 1)
    SELECT model, CAST(n_tokens AS BIGINT) AS n_tokens, budget, CASE WHEN budget IS NULL THEN 'no_budget' WHEN n_tokens >= budget THEN 'exceeded' WHEN n_tokens * 100 >= budget * 80 THEN 'warning'
               ELSE 'within' END AS state FROM u LEFT JOIN m USING (model)""")
def token_budgets(spark, sf_dir):
    spent = table(spark, sf_dir, "events").select(F.col("event_type").alias("model"), (F.col("event_id") % 100).alias("n_tokens"))
    budgets = spark.createDataFrame([("view", 1), ("click", 100_000_000), ("click", 200_000_000), ("signup", 120_000)], "model string, budget int")
    return provider.budget_states(spent, budgets).select("model", "n_tokens", "budget", "state")


@query("""
    SELECT count(*) FILTER (WHERE k > 0) AS n_primary, count(*) FILTER (WHERE k = 2) AS n_fallback FROM (SELECT event_id % 3 AS k FROM events)""")
def route_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.array_repeat(F.lit("r"), (F.col("event_id") % 3).cast("int")).alias("routes"))
    return provider.route_counts(rows)


@query("""
    SELECT round(CAST(sum(CASE WHEN event_id % 3 > 0 THEN CAST(value AS DECIMAL(12, 2)) ELSE 0 END) AS DOUBLE), 2) AS total_usd FROM events""")
def total_cost(spark, sf_dir):
    """The sum of costs, of which every third is not known."""
    cost = F.when(F.col("event_id") % 3 > 0, F.col("value").cast("decimal(12,2)"))
    found = provider.total_cost(table(spark, sf_dir, "events").select(cost.alias("estimated_usd")))
    return found.select(F.round(F.col("total_usd").cast("double"), 2).alias("total_usd"))


@query("""
    SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 11 = 0 THEN 'no_recorded_response' WHEN o_orderkey % 13 = 0 THEN 'several_recorded_responses'
               WHEN o_orderkey % 7 = 0 THEN 'segment_twice' WHEN o_orderkey % 5 = 0 THEN 'segment_missing' WHEN o_orderkey % 3 = 0 THEN 'segment_not_asked'
               WHEN o_orderkey % 17 = 0 THEN 'empty_target' END AS fault FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def recorded_responses(spark, sf_dir):
    """Requests for two segments against recorded answers that lack, repeat or add some."""
    key = F.col("o_orderkey")
    one = lambda name, text="t": F.struct(F.lit(name).alias("segment_id"), F.lit(text).alias("target_text"))
    answer = (
        F.when(key % 7 == 0, F.array(one("a"), one("a"), one("b"))).when(key % 5 == 0, F.array(one("a"))).when(key % 3 == 0, F.array(one("a"), one("b"), one("c")))
        .when(key % 17 == 0, F.array(one("a"), one("b", ""))).otherwise(F.array(one("a"), one("b")))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    requests = orders.select(key.alias("request_id"), F.array(F.lit("a"), F.lit("b")).alias("segment_ids"))
    given = orders.where(key % 11 != 0).select(key.alias("request_id"), answer.alias("segments"))
    return provider.recorded(requests, given.unionByName(given.where(F.col("request_id") % 13 == 0))).select("request_id", "fault")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'done' WHEN o_orderkey % 5 = 0 THEN 'manual_recovery' ELSE 'to_send' END AS state
    FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def leaf_claims(spark, sf_dir):
    """Jobs with results, with claims only, and with neither."""
    jobs = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    claims = jobs.where("o_orderkey % 5 = 0 or o_orderkey % 3 = 0")
    return provider.pending(jobs, jobs.where("o_orderkey % 3 = 0"), claims, "o_orderkey").select("o_orderkey", "state")


_STATES = """
    WITH l AS (SELECT l_orderkey AS o, count(DISTINCT l_linenumber) AS n, bool_or(l_returnflag = 'R' AND l_linenumber = 1) AS open FROM lineitem GROUP BY 1),
    e AS (SELECT o_orderkey AS o, o_orderkey % 4 AS want FROM (SELECT DISTINCT o_orderkey FROM orders)),
    s AS (SELECT e.o, CASE WHEN want = 0 THEN 'no_translatable_segments' WHEN coalesce(n, 0) < want THEN 'incomplete' WHEN open THEN 'research_needed' ELSE 'translated' END AS status,
                 coalesce(n, 0) AS n_leaves FROM e LEFT JOIN l USING (o))"""


def _states(spark, sf_dir):
    """Orders as episodes of up to three segments, their lines as finished leaves."""
    lines = table(spark, sf_dir, "lineitem")
    leaves = lines.select(
        F.col("l_orderkey").alias("episode_id"), F.col("l_linenumber").alias("segment_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), "research_needed").otherwise("translated").alias("status"),
    )
    episodes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode_id"), (F.col("o_orderkey") % 4).alias("n_segments")).distinct()
    return provider.episode_states(episodes, leaves)


@query(_STATES + " SELECT o AS episode_id, status, n_leaves FROM s")
def episode_results(spark, sf_dir):
    return _states(spark, sf_dir)


@query(_STATES + """
    SELECT DISTINCT o AS episode_id, o * 100 + l_linenumber AS unit_id FROM s JOIN lineitem ON l_orderkey = o
    WHERE status = 'translated' AND (o * 100 + l_linenumber) % 4 <> 1""")
def judge_inputs(spark, sf_dir):
    """Units of translated episodes, of which every fourth is judged already."""
    unit = (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("unit_id")
    units = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_id"), unit).distinct()
    return provider.judge_inputs(_states(spark, sf_dir), units, units.where("unit_id % 4 = 1").select("unit_id"))


@query("""
    SELECT o_orderkey AS episode_id FROM (SELECT DISTINCT o_orderkey FROM orders)
    WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 > 0 AND o_orderkey % 5 = 1""")
def recovery_selection(spark, sf_dir):
    """Episodes in review whose last route failed with one of the statuses that may be tried again."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    route = lambda name, status: F.struct(F.lit(name).alias("route"), status.alias("status"))
    results = orders.select(
        key.alias("episode_id"),
        F.when(key % 2 == 0, "needs_review").otherwise("translated").alias("status"),
        F.array(route("first", F.lit("failed")), route("second", F.when(key % 3 > 0, "failed").otherwise("done"))).alias("routes"),
    )
    attempts = orders.select(
        key.alias("episode_id"), F.lit("second").alias("route"), F.lit("failed").alias("outcome"), F.when(key % 5 == 1, 429).otherwise(500).alias("http_status")
    )
    return provider.recovery_selection(results, attempts.unionByName(attempts.withColumn("route", F.lit("first")).withColumn("http_status", F.lit(402))))


# -- files ---------------------------------------------------------------------------
def _written(spark, sf_dir, name: str) -> str:
    """Documents as JSONL lines, some of them no records, in files by language, of each part of the input its own."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    number = F.col("doc_id")
    good = obj(id=json_string(F.concat(F.lit("d"), number.cast("string"))), text=json_string(F.col("text")), n=F.col("n_chars").cast("string"))
    line = (
        F.when(number % 10 == 1, F.lit("")).when(number % 10 == 2, F.substring(good, F.lit(1), F.length(good) - 1)).when(number % 10 == 3, F.lit('{"a":1,"a":2}'))
        .when(number % 10 == 4, F.lit("[1]")).when(number % 10 == 5, F.lit('{"a":NaN}')).otherwise(F.concat(good, F.when(number % 10 == 6, F.lit("\r")).otherwise(F.lit(""))))
    )
    rows = table(spark, sf_dir, "documents").select("lang", line.alias("value"))
    parts = rows.write.partitionBy("lang").option("lineSep", "\n")
    parts.format("text").save(folder)
    return folder


@query(f"""
    WITH g AS (SELECT doc_id % 10 AS k, '{{"id":"d' || doc_id || '","n":' || n_chars || ',"text":' || {js('text')} || '}}' AS good FROM documents),
    c AS (SELECT CASE k WHEN 1 THEN 'PARSE_EMPTY_RECORD' WHEN 2 THEN 'PARSE_INVALID_JSON' WHEN 3 THEN 'PARSE_DUPLICATE_KEY' WHEN 4 THEN 'SCHEMA_EXPECTED_OBJECT' WHEN 5 THEN 'PARSE_NON_FINITE_NUMBER'
                        ELSE CASE WHEN strlen(good) > 16384 THEN 'PARSE_RECORD_TOO_LARGE' END END AS code,
                 CASE k WHEN 1 THEN 0 WHEN 2 THEN strlen(good) - 1 WHEN 3 THEN 13 WHEN 4 THEN 3 WHEN 5 THEN 9 ELSE strlen(good) END AS size FROM g),
    d AS (SELECT CASE WHEN size > 16384 THEN 'PARSE_RECORD_TOO_LARGE' ELSE code END AS code, size FROM c)
    SELECT code, CASE WHEN code IS NULL THEN 'valid' ELSE 'quarantined' END AS status, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS n_bytes FROM d GROUP BY 1, 2""")
def bronze_quarantine_accounting(spark, sf_dir):
    """Documents written as JSONL files, registered, ingested by byte ranges and accounted for."""
    folder = _written(spark, sf_dir, "bronze")
    _rename(spark, folder, ".txt", ".jsonl")
    snapshot = jsonl.register(spark, folder, "documents", "r1")
    bronze = jsonl.ingest(spark, snapshot, 16384)
    return bronze.groupBy("code", "status").agg(F.count("*").alias("n_rows"), F.sum("byte_length").cast("long").alias("n_bytes"))


def _rename(spark, folder: str, old: str, new: str) -> None:
    """Give the files of a folder another ending."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed, names = store.listFiles(root, True), []
    while listed.hasNext():
        names.append(listed.next().getPath().toString())
    for name in names:
        if name.endswith(old):
            store.rename(jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.hadoop.fs.Path(name.removesuffix(old) + new))


@query("""
    WITH t AS (SELECT conv_id, list('{"content":' || """ + js("text") + """ || ',"role":"' || role || '"}' ORDER BY turn) AS ms FROM conversations GROUP BY conv_id)
    SELECT conv_id, '{"id":"' || conv_id || '","messages":[' || array_to_string(ms, ',') || ']}' AS line FROM t""")
def conversation_export(spark, sf_dir):
    return publish.conversation_lines(table(spark, sf_dir, "conversations"), "conv_id")


@query("""
    WITH d AS (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[0-9]+')) AS v, doc_id FROM documents)
    SELECT doc_id, count(*) AS n, CAST(sum(length(v)) AS BIGINT) AS width FROM d GROUP BY doc_id""")
def number_spans(spark, sf_dir):
    """Spans of digits in every text: as many as the SQL finds, each as wide as what it covers."""
    found = spans.found(F.coalesce("text", F.lit("")), "n", "[0-9]+")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.explode(found).alias("s"))
    right = F.substring("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")) == F.col("s.value")
    return rows.where(right).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col("s.end") - F.col("s.start")).cast("long").alias("width"))

