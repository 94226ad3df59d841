"""Registered queries of model exchanges, memory, audits read back, times and diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.jcs import arr, json_string, obj
from ..operators import audit, evidence, exchange, histories, selection, tools
from .reference import ORACLES, QUERIES, js, query, table
from .review import _listed

__all__ = ["ORACLES", "QUERIES"]


@query("""
    SELECT event_id, CASE WHEN k <> 1 AND event_type NOT IN ('error', 'view', 'signup') THEN 'said ' || event_id END AS text,
           CASE WHEN event_type = 'error' THEN 'no_envelope' WHEN k = 1 AND style = 'chat' THEN 'not_one_choice' WHEN k = 1 THEN 'not_one_text'
                WHEN event_type = 'view' AND style = 'chat' THEN 'not_stopped' WHEN event_type = 'view' THEN 'not_one_text' WHEN event_type = 'signup' THEN 'no_text' END AS fault
    FROM (SELECT event_id, event_type, event_id % 5 AS k, CASE WHEN event_id % 2 = 0 THEN 'chat' ELSE 'responses' END AS style FROM events)""")
def answer_texts(spark, sf_dir):
    """Answers of both styles: torn, doubled, cut off or without text."""
    number, kind = F.col("event_id"), F.col("event_type")
    said = F.when(kind == "signup", F.lit("null")).otherwise(json_string(F.concat(F.lit("said "), number.cast("string"))))
    choice = obj(finish_reason=F.when(kind == "view", F.lit('"length"')).otherwise(F.lit('"stop"')), message=obj(content=said))
    twice = lambda x: F.when(number % 5 == 1, F.concat(x, F.lit(","), x)).otherwise(x)
    chat = F.concat(F.lit('{"choices":['), twice(choice), F.lit("]}"))
    part = obj(type=F.when(kind == "view", F.lit('"refusal"')).otherwise(F.lit('"output_text"')), text=said)
    message = obj(type=F.lit('"message"'), content=F.concat(F.lit("["), twice(part), F.lit("]")))
    answer = F.concat(F.lit('{"output":[{"type":"reasoning","content":null},'), message, F.lit("]}"))
    torn = lambda x: F.when(kind == "error", F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x)
    found = F.when(number % 2 == 0, exchange.chat_text(torn(chat))).otherwise(exchange.responses_text(torn(answer)))
    return table(spark, sf_dir, "events").select("event_id", found.alias("a")).select("event_id", "a.text", "a.fault")


@query("""
    SELECT event_id, sha256('{"max_tokens":64,"messages":[{"content":"be brief","role":"system"},{"content":' || replace(replace(to_json(props)::VARCHAR, chr(0), ''), chr(0), '')
               || ',"role":"user"}],"model":"' || event_type || '","response_format":{"type":"json_object"},"stream":false,"thinking":{"type":"disabled"}}') AS chat,
           sha256('{"input":[{"content":[{"text":"be brief","type":"input_text"}],"role":"system"},{"content":[{"text":' || to_json(props)::VARCHAR
               || ',"type":"input_text"}],"role":"user"}],"metadata":{"request_id":"r' || event_id || '"},"model":"' || event_type
               || '","store":false,"text":{"format":{"name":"out","schema":{"type":"object"},"strict":true,"type":"json_schema"}}}') AS responses FROM events""")
def request_bodies(spark, sf_dir):
    """The digests of the bytes that would be sent in either style."""
    model, system, user = F.col("event_type"), F.lit("be brief"), F.col("props")
    metadata = {"request_id": F.concat(F.lit("r"), F.col("event_id").cast("string"))}
    chat = exchange.chat_request(model, system, user, 64)
    responses = exchange.responses_request(model, system, user, "out", '{"type":"object"}', metadata)
    return table(spark, sf_dir, "events").select("event_id", F.sha2(chat, 256).alias("chat"), F.sha2(responses, 256).alias("responses"))


@query(f"""
    WITH j AS (SELECT event_id, event_type AS k, event_id % 3 AS f, event_id % 4 = 0 AS r, event_id % 7 = 0 AS stray FROM events)
    SELECT event_id, CASE WHEN k = 'error' THEN 'no_judgement' ELSE {_listed(
        ("k = 'view' AND (f > 0 OR r)", "pass_with_findings_or_reasons"),
        ("k = 'click' AND (f = 0 OR r)", "fail_without_findings_or_with_reasons"),
        ("k = 'signup' AND NOT r", "review_without_reasons"),
        ("k = 'purchase'", "unknown_conclusion"),
        ("stray AND f > 0", "excerpt_not_in_text"),
    )} END AS faults FROM j""")
def judge_answers(spark, sf_dir):
    """Judgements whose conclusion, findings and reasons come from different residues; some quote what is not there."""
    number, kind = F.col("event_id"), F.col("event_type")
    finding = obj(
        category=F.lit('"accuracy"'), severity=F.lit('"minor"'), source_excerpt=F.when(number % 7 == 0, F.lit('"zzz"')).otherwise(json_string(kind)),
        target_excerpt=F.lit('"out"'), rationale=F.lit('"x"'),
    )
    findings = F.when(number % 3 == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), F.array_join(F.array_repeat(finding, (number % 3).cast("int")), ","), F.lit("]")))
    conclusion = F.when(kind == "view", '"pass"').when(kind == "click", '"fail"').when(kind == "signup", '"needs_human_review"').otherwise(F.lit('"odd"'))
    answer = obj(conclusion=conclusion, findings=findings, unresolved_reasons=F.when(number % 4 == 0, F.lit('["r"]')).otherwise(F.lit("[]")))
    answer = F.when(kind == "error", F.lit("no json")).otherwise(answer)
    made = exchange.judgement(answer, F.concat(F.lit("the "), kind), F.lit("an out text"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(made["faults"], ",").alias("faults"))


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM events""")
def utc_times(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"))


@query(f"""
    SELECT doc_id, 'mem_' || sha256('{{"argument_policy_version":"a","decision_action":"clarification","field_policy_version":"f","human_review_event_id":"evt_' || doc_id
               || '","locale_policy_version":"' || lang || '","origin_translation_config_id":"cfg","presented_context_fingerprint":"ctx","schema_version":"segment-memory-0.1.0","segment_source_sha256":"sha256:'
               || sha256(text) || '","source_text":' || {js('text')} || ',"state":"active","target_text":"' || source || '","target_text_sha256":"sha256:' || sha256(source)
               || '","tool_scope":["tool_a","tool_b"]}}') AS memory_entry_id FROM documents""")
def memory_entries(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("source_text"), F.col("source").alias("target_text"), F.lit("f").alias("field_policy_version"), F.lit("a").alias("argument_policy_version"),
        F.col("lang").alias("locale_policy_version"), F.lit("ctx").alias("presented_context_fingerprint"), F.lit("clarification").alias("decision_action"),
        F.array(F.lit("tool_b"), F.lit("tool_a"), F.lit("tool_b")).alias("tool_scope"), F.lit("cfg").alias("origin_translation_config_id"),
        F.concat(F.lit("evt_"), F.col("doc_id").cast("string")).alias("human_review_event_id"), F.lit("active").alias("state"),
    )
    return tools.memory_entries(rows).select("doc_id", "memory_entry_id")


@query("""
    WITH g AS (SELECT lang, doc_id, 'e' || doc_id AS e, 'e' || min(doc_id) OVER (PARTITION BY lang) AS owner, doc_id % 2 = 0 AS left_ FROM documents)
    SELECT 'audit_' || lang AS audit_id, 'conflict' AS kind, 'conf_' || lang AS group_id, e AS episode_id FROM g WHERE lang <> 'de'
    UNION ALL SELECT 'audit_' || lang, 'alias', owner, e FROM g WHERE e <> owner AND lang <> 'de'
    UNION ALL SELECT NULL, 'unreadable', NULL, NULL FROM (SELECT DISTINCT lang FROM g WHERE lang = 'de')""")
def audit_members(spark, sf_dir):
    """An audit for each language, as JSON; that of one language is torn."""
    name = F.concat(F.lit("e"), F.col("doc_id").cast("string"))
    sides = table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.min("doc_id").alias("first"),
        F.collect_list(F.when(F.col("doc_id") % 2 == 0, name)).alias("left"),
        F.collect_list(F.when(F.col("doc_id") % 2 == 1, name)).alias("right"),
    )
    owner = F.concat(F.lit("e"), F.col("first").cast("string"))
    listed = lambda x: arr(F.transform(x, json_string))
    group = obj(owner_episode_id=json_string(owner), alias_episode_ids=listed(F.filter(F.concat("left", "right"), lambda e: e != owner)))
    clash = obj(conflict_id=json_string(F.concat(F.lit("conf_"), "lang")), left_member_episode_ids=listed(F.col("left")), right_member_episode_ids=listed(F.col("right")))
    body = obj(audit_id=json_string(F.concat(F.lit("audit_"), "lang")), duplicate_groups=arr(F.array(group)), conflict_candidates=arr(F.array(clash)))
    value = F.when(F.col("lang") == "de", F.lit('{"audit')).otherwise(body)
    return audit.audit_members(sides.select(value.alias("value")))


@query("""
    SELECT event_id, 'SOURCE_ARG_NOT_GROUNDED' AS code, '/n' AS json_pointer, 'call c' || event_id || ': ' || CASE WHEN event_type = 'view' THEN 'unsupported by must_not_infer'
               WHEN event_type = 'click' THEN 'unsupported by unknown' ELSE 'unresolved by unknown' END AS message
    FROM events WHERE event_type IN ('view', 'click', 'error')""")
def grounding_diagnostics(spark, sf_dir):
    """Arguments with evidence that is forbidden, leads to the wrong place, is missing, or holds."""
    kind, number = F.col("event_type"), F.col("event_id")
    call = F.concat(F.lit("c"), number.cast("string"))
    events = table(spark, sf_dir, "events")
    expected = events.select(number.alias("episode"), call.alias("call_id"), F.lit("/n").alias("argument_pointer"))
    given = events.where(kind != "error").select(
        number.alias("episode"), call.alias("call_id"), F.lit("/n").alias("argument_pointer"),
        F.when(kind == "view", "must_not_infer").otherwise("explicit_user").alias("origin"),
        F.array(F.when(kind == "click", "/conversation/1/content").otherwise("/conversation/0/content")).alias("evidence_pointers"),
        F.array().cast("array<string>").alias("input_pointers"), F.lit(True).alias("resolves"),
    )
    contexts = events.select(number.alias("episode"), F.array(F.lit("user"), F.lit("assistant"), F.lit("assistant")).alias("roles"), F.lit(2).alias("target"))
    found = evidence.diagnostics(evidence.grounding(expected, given, contexts))
    return found.select(F.col("episode").alias("event_id"), "code", "json_pointer", "message")


@query("""
    WITH k AS (SELECT doc_id, n_chars, 'sha256:' || sha256('{"canary_policy_version":"pre-review-canary-0.1.0","episode_id":"' || doc_id || '","input_variant_id":"v"}') AS rank_key FROM documents)
    SELECT doc_id, rank_key, row_number() OVER (ORDER BY rank_key, doc_id) AS rank FROM k""")
def canary_ranks(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", selection.cohort_key("canary_policy_version", F.col("doc_id").cast("string"), F.lit("v")).alias("rank_key"))
    return selection.ordered_rank(keyed, ["rank_key", "doc_id"])


@query("""
    WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, role FROM conversations)
    SELECT CAST(conv_id AS VARCHAR) AS episode_id, 'sha256:' || sha256('{"conversation":[' || string_agg('{"images":null,"name":null,"role":"' || role
               || '","tool_call_id":null,"tool_calls":null}', ',' ORDER BY i) || '],"target_message_index":' || max(i) || ',"tools":[]}') AS structure_sha256
    FROM t GROUP BY conv_id""")
def technical_structures(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("episode_id"), (F.row_number().over(order) - 1).alias("position"), "role", F.col("text").alias("content"),
        F.lit(None).cast("array<struct<id:string,name:string,arguments:string>>").alias("calls"), F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("name"),
    )
    none = spark.createDataFrame([], "episode_id string, position int, tool string")
    return histories.technical_structure(turns, none)
