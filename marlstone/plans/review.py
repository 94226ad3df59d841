"""Registered queries of review: verdicts, findings, tasks, adjudications, coverage, ranks, diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import diagnostics, scan
from ..operators import evaluation, ledger, release, render, research, review
from .reference import _JUDGED, ORACLES, QUERIES, _judged, query, table

__all__ = ["ORACLES", "QUERIES"]


def _listed(*pairs: tuple[str, str]) -> str:
    """SQL of the names whose conditions hold, in order, joined by commas."""
    each = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for test, name in pairs)
    return f"array_to_string(list_filter([{each}], lambda x: x IS NOT NULL), ',')"


@query(f"""
    WITH v AS (
        SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'needs_human_review' ELSE 'other' END AS c,
               CASE doc_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS f, CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS r FROM documents)
    SELECT doc_id, {_listed(
        ("c = 'pass' AND (f > 0 OR r > 0)", "pass_with_findings_or_reasons"),
        ("c = 'fail' AND (f = 0 OR r > 0)", "fail_without_findings_or_with_reasons"),
        ("c = 'needs_human_review' AND r = 0", "review_without_reasons"),
        ("c = 'other'", "unknown_conclusion"),
        ("f = 2", "findings_not_sorted_or_repeated"),
        ("r = 2", "reasons_not_sorted_or_repeated"),
    )} AS faults FROM v""")
def verdict_faults(spark, sf_dir):
    number = F.col("doc_id")
    conclusion = F.when(number % 4 == 0, "pass").when(number % 4 == 1, "fail").when(number % 4 == 2, "needs_human_review").otherwise("other")
    none = F.array().cast("array<string>")
    findings = F.when(number % 3 == 0, none).when(number % 3 == 1, F.array(F.lit("f1"))).otherwise(F.array(F.lit("f2"), F.lit("f1")))
    reasons = F.when(number % 5 == 0, F.array(F.lit("r"))).when(number % 5 == 1, F.array(F.lit("r"), F.lit("r"))).otherwise(none)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(review.verdict_faults(conclusion, findings, reasons), ",").alias("faults"))


@query("""
    WITH f AS (SELECT source AS category, CASE WHEN toxic = 1 THEN 'critical' WHEN quality = 0 THEN 'major' ELSE 'minor' END AS severity, 1 + doc_id % 2 AS k
               FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 > 0)
    SELECT category, severity, CAST(sum(k) AS BIGINT) AS n FROM f GROUP BY 1, 2""")
def finding_counts(spark, sf_dir):
    """Findings of judged documents: none, one or two of a kind."""
    rows, number = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id"), F.col("doc_id")
    severity = F.when(F.col("toxic") == 1, "critical").when(F.col("quality") == 0, "major").otherwise("minor")
    one = F.struct(F.col("source").alias("category"), severity.alias("severity"))
    findings = F.when(number % 3 == 0, F.array().cast("array<struct<category:string,severity:string>>")).otherwise(F.array_repeat(one, (1 + number % 2).cast("int")))
    return review.finding_counts(rows.select(findings.alias("findings")))


_TASKS = """
    WITH q AS (SELECT DISTINCT 'quar_' || doc_id % 60 AS id, '{"n":' || CASE WHEN doc_id % 60 < 5 THEN doc_id % 7 ELSE 1 END || '}' AS body FROM documents),
    qn AS (SELECT id, min(body) AS body, count(*) AS n FROM q GROUP BY id),
    c AS (SELECT 'conf_' || user_id AS id, '{"n":' || CASE WHEN user_id % 10 = 0 THEN event_id % 2 ELSE 1 END || '}' AS body, 'audit_' || event_id % 3 AS audit FROM events),
    cn AS (SELECT id, min(body) AS body, count(DISTINCT body) AS n, list_sort(list_distinct(list(audit))) AS audits FROM c GROUP BY id)
"""


@query(_TASKS + """
    SELECT 'reviewtask_' || sha256('{"action":"remediate_canonical_quarantine","audit_ids":[],"canonical_quarantine":' || body
               || ',"conflict_candidate":null,"reviewer_authority":"human","schema_version":"review-task-0.1.0","task_kind":"canonical_quarantine"}') AS task_id,
           'canonical_quarantine' AS task_kind, id AS evidence_id, '' AS audit_ids FROM qn WHERE n = 1
    UNION ALL
    SELECT 'reviewtask_' || sha256('{"action":"submit_conflict_adjudication","audit_ids":["' || array_to_string(audits, '","') || '"],"canonical_quarantine":null,"conflict_candidate":' || body
               || ',"reviewer_authority":"human","schema_version":"review-task-0.1.0","task_kind":"conflict_adjudication"}'),
           'conflict_adjudication', id, array_to_string(audits, ',') FROM cn WHERE n = 1""")
def review_tasks(spark, sf_dir):
    made, _ = _tasks(spark, sf_dir)
    return made.select("task_id", "task_kind", "evidence_id", F.array_join("audit_ids", ",").alias("audit_ids"))


@query(_TASKS + "SELECT id AS evidence_id FROM qn WHERE n > 1 UNION ALL SELECT id FROM cn WHERE n > 1")
def contradicting_evidence(spark, sf_dir):
    return _tasks(spark, sf_dir)[1]


def _tasks(spark, sf_dir):
    """Quarantines seen again and again, conflicts named by up to three audits; some with two bodies."""
    number, user, event = F.col("doc_id"), F.col("user_id"), F.col("event_id")
    body = lambda n: F.concat(F.lit('{"n":'), n.cast("string"), F.lit("}"))
    held = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("quar_"), (number % 60).cast("string")).alias("quarantine_id"), body(F.when(number % 60 < 5, number % 7).otherwise(F.lit(1))).alias("body")
    )
    clashing = table(spark, sf_dir, "events").select(
        F.concat(F.lit("conf_"), user.cast("string")).alias("conflict_id"),
        body(F.when(user % 10 == 0, event % 2).otherwise(F.lit(1))).alias("body"),
        F.concat(F.lit("audit_"), (event % 3).cast("string")).alias("audit_id"),
    )
    return review.tasks(held, clashing)


@query(f"""
    WITH e AS (SELECT user_id, event_id, event_type, value, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
    s AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN event_id ELSE before END AS supersedes FROM e)
    SELECT event_id, {_listed(
        ("supersedes IS DISTINCT FROM before", "supersedes_other_than_the_current"),
        ("event_id % 11 = 0", "one_episode_twice"),
        ("event_type = 'view'", "unknown_decision"),
        ("event_type = 'error'", "not_a_person"),
        ("value < 3", "no_rationale"),
    )} AS faults FROM s""")
def adjudication_faults(spark, sf_dir):
    """Each user's events as decisions of one conflict, broken by number, type and value."""
    from pyspark.sql import Window

    event, kind = F.col("event_id"), F.col("event_type")
    before = F.lag("event_id").over(Window.partitionBy("user_id").orderBy("event_id"))
    log = table(spark, sf_dir, "events").select(
        event.alias("sequence"), "event_id", F.col("user_id").alias("conflict_id"), event.alias("left_id"),
        F.when(event % 11 == 0, event).otherwise(-event - 1).alias("right_id"),
        F.when(kind == "view", "look").otherwise("defer").alias("decision"), F.when(kind == "error", "model").otherwise("human").alias("authority"),
        F.when(F.col("value") < 3, "").otherwise("since").alias("rationale"), F.when(event % 7 == 0, event).otherwise(before).alias("supersedes"),
    )
    return review.adjudication_faults(log).select("event_id", F.array_join("faults", ",").alias("faults"))


@query(f"""
    WITH r AS (SELECT doc_id, doc_id % 300 AS review_id, doc_id // 2 AS verdict_id, toxic FROM labels),
    c AS (SELECT *, count(*) OVER (PARTITION BY review_id) AS a, count(*) OVER (PARTITION BY verdict_id) AS b FROM r)
    SELECT doc_id, {_listed(("a > 1", "review_id_twice"), ("b > 1", "verdict_reviewed_twice"), ("toxic = 1", "not_a_person"))} AS faults FROM c""")
def human_review_faults(spark, sf_dir):
    number = F.col("doc_id")
    log = table(spark, sf_dir, "labels").select(
        "doc_id", (number % 300).alias("review_id"), F.floor(number / 2).alias("verdict_id"), F.when(F.col("toxic") == 1, "model").otherwise("human").alias("authority")
    )
    return review.human_review_faults(log).select("doc_id", F.array_join("faults", ",").alias("faults"))


@query("""
    WITH r AS (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE toxic = 1)
    SELECT doc_id, count(d.doc_id) > 0 AS known, count(*) AS n_right FROM r LEFT JOIN documents d USING (doc_id) GROUP BY doc_id HAVING n_right > 1
    UNION ALL SELECT doc_id, true, 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r)""")
def coverage_faults(spark, sf_dir):
    """Documents as what was asked for, labels as what came, toxic ones twice."""
    labels = table(spark, sf_dir, "labels")
    found = review.coverage_faults(table(spark, sf_dir, "documents"), labels.select("doc_id").unionByName(labels.where("toxic = 1").select("doc_id")), "doc_id")
    return found.select("doc_id", (F.col("n_left") > 0).alias("known"), "n_right")


@query("""
    SELECT source, array_to_string(list_sort(list_distinct(list(reason))), ',') AS reasons
    FROM (SELECT source, CASE WHEN quality = 0 THEN 'low_quality' END AS reason FROM documents JOIN labels USING (doc_id)
          UNION ALL SELECT source, CASE WHEN toxic = 1 THEN 'toxic_' || lang END FROM documents JOIN labels USING (doc_id)) WHERE reason IS NOT NULL GROUP BY source""")
def block_reasons(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    found = F.array_compact(F.array(F.when(F.col("quality") == 0, "low_quality"), F.when(F.col("toxic") == 1, F.concat(F.lit("toxic_"), "lang"))))
    return review.block_reasons(rows.select("source", found.alias("reasons")), "source", "reasons").select("source", F.array_join("reasons", ",").alias("reasons"))


@query("""
    WITH r AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT l_orderkey, min(l_linenumber) AS first, max(l_linenumber) AS last, count(*) AS n_ranks, CAST(sum(n) AS BIGINT) AS n_rows
    FROM r GROUP BY 1 HAVING first <> 1 OR last <> n_ranks OR n_rows <> n_ranks""")
def rank_faults(spark, sf_dir):
    """Orders whose line numbers are not 1 .. n, each once."""
    return review.rank_faults(table(spark, sf_dir, "lineitem"), "l_linenumber", "l_orderkey")


@query("""
    WITH m AS (SELECT doc_id, doc_id % 40 AS review FROM labels), c AS (SELECT *, count(*) OVER (PARTITION BY review) AS n FROM m)
    SELECT doc_id AS episode_id, review AS human_review_id FROM c WHERE n > 1""")
def shared_reviews(spark, sf_dir):
    members = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("episode_id"), (F.col("doc_id") % 40).alias("human_review_id"))
    return release.shared_reviews(members)


@query("""
    WITH r AS (SELECT row_number() OVER (ORDER BY doc_id) AS position, doc_id FROM documents), m AS (SELECT row_number() OVER (ORDER BY doc_id) AS position, doc_id FROM labels)
    SELECT position, r.doc_id AS row_episode, m.doc_id AS member_episode FROM r FULL JOIN m USING (position) WHERE r.doc_id IS DISTINCT FROM m.doc_id""")
def release_order(spark, sf_dir):
    from ..operators.selection import ordered_rank

    ranked = lambda name: ordered_rank(table(spark, sf_dir, name).select(F.col("doc_id").alias("episode_id")), ["episode_id"], "position")
    return release.order_problems(ranked("documents"), ranked("labels"))


@query("""
    WITH e AS (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events)
    SELECT event_id, CASE WHEN event_id % 9 = 0 THEN before IS NULL ELSE true END AS supersedes_ok FROM e""")
def superseding_links(spark, sf_dir):
    from pyspark.sql import Window

    before = F.lag("event_id").over(Window.partitionBy("user_id").orderBy("event_id"))
    log = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 9 != 0, before).alias("supersedes"))
    return ledger.supersedes_ok(log, "user_id", "event_id", "event_id", "supersedes").select("event_id", "supersedes_ok")


@query("""
    SELECT event_id, code, CASE code WHEN 'PARSE_INVALID_JSON' THEN 'ingest' WHEN 'TOOL_NAME_UNRESOLVED' THEN 'canonicalize' WHEN 'CONFLICT_ORDER_AMBIGUITY' THEN 'dedup'
                                    WHEN 'RELEASE_EVENT_CHAIN_INVALID' THEN 'events' END AS stage,
           CASE code WHEN 'CONFLICT_ORDER_AMBIGUITY' THEN 'warning' WHEN 'NO_SUCH_CODE' THEN NULL ELSE 'error' END AS severity, code <> 'NO_SUCH_CODE' AS known
    FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'PARSE_INVALID_JSON' WHEN 'view' THEN 'TOOL_NAME_UNRESOLVED' WHEN 'click' THEN 'CONFLICT_ORDER_AMBIGUITY'
                                           WHEN 'signup' THEN 'RELEASE_EVENT_CHAIN_INVALID' ELSE 'NO_SUCH_CODE' END AS code FROM events)""")
def diagnostic_meanings(spark, sf_dir):
    codes = {"error": "PARSE_INVALID_JSON", "view": "TOOL_NAME_UNRESOLVED", "click": "CONFLICT_ORDER_AMBIGUITY", "signup": "RELEASE_EVENT_CHAIN_INVALID"}
    code = F.lit("NO_SUCH_CODE")
    for kind, name in codes.items():
        code = F.when(F.col("event_type") == kind, name).otherwise(code)
    rows = table(spark, sf_dir, "events").select("event_id", code.alias("code"))
    return diagnostics.described(rows).select("event_id", "code", "stage", "severity", "known")


@query(f"""
    WITH e AS (SELECT event_id, 'https://' || CASE event_type WHEN 'error' THEN '10.0.0.' || event_id % 200 WHEN 'view' THEN 'docs.internal' WHEN 'click' THEN 'u:p@site.example.org'
                      ELSE 'site.example.org' END || '/' || event_id AS url, event_id % 5 AS q, event_id % 8 AS s, event_id % 90 AS t, event_type AS k FROM events)
    SELECT event_id, CASE k WHEN 'error' THEN 'endpoint.private_address' WHEN 'view' THEN 'endpoint.private_hostname' WHEN 'click' THEN 'endpoint.embedded_credentials' END AS rule,
           {_listed(("k IN ('error', 'view', 'click')", "address_not_public_https"), ("q NOT BETWEEN 1 AND 3", "query_budget"), ("s NOT BETWEEN 1 AND 5", "source_budget"), ("t > 60", "time_budget"))} AS faults
    FROM e""")
def research_requests(spark, sf_dir):
    """Requests to addresses of four kinds with counts around their budgets."""
    kind, number = F.col("event_type"), F.col("event_id")
    host = (
        F.when(kind == "error", F.concat(F.lit("10.0.0."), (number % 200).cast("string"))).when(kind == "view", "docs.internal")
        .when(kind == "click", "u:p@site.example.org").otherwise("site.example.org")
    )
    url = F.concat(F.lit("https://"), host, F.lit("/"), number.cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", scan.endpoint_rules(F.array(url), need_https=True).alias("rules"))
    rule = F.get("rules", F.lit(0))
    faults = research.request_faults(rule, number % 5, number % 8, number % 90)
    return rows.select("event_id", rule.alias("rule"), F.array_join(faults, ",").alias("faults"))


@query("""
    WITH t AS (SELECT conv_id, turn, length(text) AS n, conv_id % 6 AS k FROM conversations WHERE role = 'assistant')
    SELECT conv_id, turn,
           CASE WHEN k = 1 THEN 'truncated' WHEN n + 2 > 400 THEN 'text_too_long' WHEN k = 2 THEN 'structure_changed' WHEN k = 3 THEN 'payload_differs'
                WHEN k = 4 THEN 'offsets_do_not_cover' WHEN k = 5 THEN 'target_cuts_a_token' END AS fault,
           CASE WHEN k = 0 AND n + 2 <= 400 THEN n END AS n_labels
    FROM t""")
def render_contract(spark, sf_dir):
    """Answers in brackets, a token for each character; the conversation's number breaks the contract."""
    kind, said = F.col("conv_id") % 6, F.col("text")
    n = F.length(said)
    text = F.concat(F.lit("["), said, F.lit("]"))
    each = F.transform(F.sequence(F.lit(0), n + 1), lambda i: F.struct(i.alias("start"), (i + 1).alias("end")))
    # in the fifth kind the bracket and the first character are one token
    joined = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(2).alias("end"))), F.slice(each, 3, n))
    offsets = F.when(kind == 4, F.slice(each, 1, n + 1)).when(kind == 5, joined).otherwise(each)
    rows = table(spark, sf_dir, "conversations").where("role = 'assistant'").select(
        "conv_id", "turn", text.alias("text"), (kind == 1).alias("truncated"), F.lit("s").alias("expected_structure"),
        F.when(kind == 2, "t").otherwise("s").alias("structure"), F.when(kind == 3, F.concat(said, F.lit("!"))).otherwise(said).alias("payload"),
        F.array(F.struct(F.lit(1).alias("start"), (n + 1).alias("end"))).alias("ranges"), offsets.alias("offsets"),
    )
    rows = rows.withColumn("token_ids", F.transform("offsets", lambda o: o["start"]))
    made = render.supervised(rows, max_characters=400)
    used = F.size(F.filter("labels", lambda x: x != ledger.IGNORED))
    return made.select("conv_id", "turn", "fault", F.when(F.col("labels").isNotNull(), used.cast("long")).alias("n_labels"))


_ESCALATED = _JUDGED + """,
    m AS (SELECT doc_id, mini AS conclusion, strong, sampled, source || '/' || lang AS unit, mini <> 'pass' OR sampled AS escalated FROM j)"""


@query(_ESCALATED + """,
    g AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'other' ELSE unit END AS unit, unnest(CASE WHEN doc_id % 17 = 0 THEN [1, 2] ELSE [1] END) AS k
          FROM m WHERE CASE WHEN escalated THEN doc_id % 11 <> 0 ELSE doc_id % 13 = 0 END),
    a AS (SELECT m.doc_id, m.escalated, m.unit, count(g.doc_id) AS n, min(g.unit) AS given FROM m LEFT JOIN g ON g.doc_id = m.doc_id GROUP BY ALL)
    SELECT doc_id, 'strong_result_missing' AS fault FROM a WHERE escalated AND n = 0
    UNION ALL SELECT doc_id, 'strong_result_not_escalated' FROM a WHERE NOT escalated AND n > 0
    UNION ALL SELECT doc_id, 'strong_result_twice' FROM a WHERE n > 1
    UNION ALL SELECT doc_id, 'other_evaluation_unit' FROM a WHERE n > 0 AND given <> unit""")
def escalation_faults(spark, sf_dir):
    """Strong results that are missing, twice, not asked for or of another unit, by the numbers of documents."""
    mini, strong = _mini_and_strong(spark, sf_dir)
    number = F.col("doc_id")
    given = strong.where(F.when(F.col("escalated"), number % 11 != 0).otherwise(number % 13 == 0))
    given = given.withColumn("unit", F.when(number % 7 == 0, "other").otherwise(F.col("unit")))
    given = given.select("*", F.explode(F.when(number % 17 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("k"))
    return evaluation.escalation_faults(mini, given, "doc_id")


@query(_ESCALATED + """
    SELECT doc_id, CASE WHEN conclusion <> 'pass' THEN 'mini_non_pass' WHEN sampled THEN 'pass_sample' END AS escalation_reason,
           CASE WHEN escalated THEN 'strong' ELSE 'mini' END AS decider,
           CASE WHEN NOT escalated OR strong = 'pass' THEN 'accepted_for_review_package' ELSE 'needs_review' END AS consensus FROM m""")
def escalated_decisions(spark, sf_dir):
    """Decisions where the strong results are exactly those of the escalated units."""
    mini, strong = _mini_and_strong(spark, sf_dir)
    return evaluation.decisions(mini, strong.where("escalated"), "doc_id")


def _mini_and_strong(spark, sf_dir):
    """Results of both judges; the strong judge's still of every document, with whether it was asked for."""
    rows = _judged(spark, sf_dir).withColumn("unit", F.concat_ws("/", "source", "lang"))
    escalated = evaluation.escalated(F.col("mini"), F.col("sampled")).alias("escalated")
    return rows.select("doc_id", F.col("mini").alias("conclusion"), "sampled", "unit"), rows.select("doc_id", F.col("strong").alias("conclusion"), "unit", escalated)
