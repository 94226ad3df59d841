"""Registered queries of tools, tool-calling episodes, field policy and translation memory."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import json_tables
from ..functions.jcs import arr, json_string, obj, sha
from ..operators import tools
from ..operators.common import small_batches
from ..sources import adapters
from .reference import ORACLES, QUERIES, js, query, table

__all__ = ["ORACLES", "QUERIES"]

_POLICY = tools.FieldPolicy("p1")


@query(f"""
    WITH p AS (
        SELECT p_brand AS name, p_name AS about,
               '{{"properties":{{' || {js('p_type')} || ':' AS head, '{{"maximum":' || p_size || ',"type":"integer"}}}},"type":"object"}}' AS form,
               '{{"description":' || {js('p_name')} || ',"maximum":' || p_size || ',"type":"integer"}}}},"type":"object"}}' AS whole
        FROM part)
    SELECT DISTINCT 'tool_' || sha256('{{"name":"' || name || '","schema":' || head || form || '}}') AS tool_id,
           'sha256:' || sha256(head || form) AS semantic_schema_hash, 'sha256:' || sha256(head || whole) AS raw_schema_hash,
           'sha256:' || sha256('{{"description":' || {js('about')} || ',"name":"' || name || '","parameters":' || head || whole || '}}') AS documentation_hash, name
    FROM p""")
def tool_registry(spark, sf_dir):
    """Each part as a tool with one bounded parameter, documented by the part's name."""
    kind = obj(description=json_string(F.col("p_name")), maximum=F.col("p_size").cast("string"), type=F.lit('"integer"'))
    parameters = obj(properties=F.concat(F.lit("{"), json_string(F.col("p_type")), F.lit(":"), kind, F.lit("}")), type=F.lit('"object"'))
    body = obj(name=json_string(F.col("p_brand")), description=json_string(F.col("p_name")), parameters=parameters)
    made = tools.registry(table(spark, sf_dir, "part").select(obj(type=F.lit('"function"'), function=body).alias("tool")))
    return made.where("code is null").select("tool_id", "semantic_schema_hash", "raw_schema_hash", "documentation_hash", "name")


@query("""
    WITH d AS (SELECT doc_id, n_chars, doc_id % 5 = 4 AS unknown, doc_id % 3 = 2 OR n_chars > 2000 AS misfit FROM documents)
    SELECT doc_id,
           CASE WHEN NOT unknown AND NOT misfit THEN 'ep_' || sha256('{"episode_schema_version":"0.1.0","id_version":1,"source_conversation_id":"' || doc_id
                || '","source_occurrence_id":"occ_' || sha256(CAST(doc_id AS VARCHAR)) || '","target_message_index":1}') END AS episode_id,
           CASE WHEN unknown THEN 'TOOL_NAME_UNRESOLVED' WHEN misfit THEN 'TOOL_ARGUMENT_SCHEMA_INVALID' END AS code,
           CASE WHEN unknown THEN '/conversation/1/tool_calls/0/function/name' WHEN misfit THEN '/conversation/1/tool_calls/0/function/arguments' END AS pointer
    FROM d""")
def canonical_call_episodes(spark, sf_dir):
    """A call for each document: every fifth names no tool, every third gives text for a number of at most 2000."""
    number = F.col("n_chars").cast("string")
    value = F.when(F.col("doc_id") % 3 == 2, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    name = F.when(F.col("doc_id") % 5 == 4, F.lit('"other"')).otherwise(F.lit('"size"'))
    call = obj(id=F.lit('"c1"'), name=name, arguments=obj(n=value))
    tool = '{"name":"size","parameters":{"properties":{"n":{"maximum":2000,"type":"integer"}},"required":["n"],"type":"object"}}'
    made = _canonical(table(spark, sf_dir, "documents"), call, tool)
    return made.select("doc_id", "e.episode_id", "e.code", "e.pointer")


def _canonical(docs, call, tool: str):
    """Each document's call as a canonical episode: doc_id and the struct ``e``."""
    small_batches(docs.sparkSession)  # a Python worker holds a batch's episodes as text and parsed
    record = obj(id=F.col("doc_id").cast("string"), query=F.lit('"how long"'), tools=F.lit(f"[{tool}]"), tool_calls=arr(F.array(call)))
    rows = docs.select("doc_id", adapters.adapt(record, "xlam").alias("a"))
    body = obj(
        source_conversation_id=json_string(F.col("a.source_conversation_id")),
        conversation=F.col("a.conversation"),
        tools=F.col("a.tools"),
        action=json_string(F.col("a.action")),
        target_message_index=F.col("a.target_message_index").cast("string"),
        observed_paths=F.to_json("a.observed_paths"),
    )
    source = obj(source_occurrence_id=json_string(F.concat(F.lit("occ_"), F.sha2(F.col("doc_id").cast("string"), 256))))
    return rows.select("doc_id", tools.canonical_episodes(obj(adapted=body, source=source), "evt_query").alias("e"))


@query("""
    SELECT doc_id, CASE WHEN (doc_id % 3 = 0 AND lang <> 'de') OR (doc_id % 4 = 0 AND n_chars >= 2000) OR (doc_id % 7 = 0 AND lang = 'de' AND doc_id % 3 <> 0)
                        THEN 'TOOL_ARGUMENT_SCHEMA_INVALID' END AS code FROM documents""")
def unevaluated_arguments(spark, sf_dir):
    """Arguments beyond what a reference, a condition, an alternative and a dependent schema evaluate."""
    number, size, lang = F.col("doc_id"), F.col("n_chars").cast("string"), F.col("lang")
    members = (
        F.concat(F.lit('"n":'), size),
        F.concat(F.lit('"kind":'), json_string(lang)),
        F.when(number % 3 == 0, F.lit('"extra":1')),
        F.when(number % 4 == 0, F.lit('"short":true')),
        F.when((number % 7 == 0) & (lang == "de"), F.lit('"deep":[1,"x"]')),
    )
    # "extra" counts where kind is de; "short" where n is small; "deep" where extra brings its schema
    schema = (
        '{"$defs":{"sized":{"properties":{"n":{"type":"integer"}},"required":["n"]}},"$ref":"#/$defs/sized",'
        '"anyOf":[{"properties":{"n":{"maximum":1999},"short":{"type":"boolean"}}},{"properties":{"n":true}}],'
        '"dependentSchemas":{"extra":{"properties":{"deep":{"prefixItems":[{"type":"integer"}],"contains":{"type":"string"},"unevaluatedItems":false}}}},'
        '"if":{"properties":{"kind":{"const":"de"}}},"then":{"properties":{"extra":{"type":"integer"}}},'
        '"properties":{"kind":{"type":"string"}},"type":"object","unevaluatedProperties":false}'
    )
    arguments = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    call = obj(id=F.lit('"c1"'), name=F.lit('"size"'), arguments=arguments)
    made = _canonical(table(spark, sf_dir, "documents"), call, f'{{"name":"size","parameters":{schema}}}')
    return made.select("doc_id", "e.code")


def _conversations(spark, sf_dir):
    """Conversations as episodes without tools."""
    turn = F.struct("turn", obj(role=json_string(F.col("role")), content=json_string(F.col("text"))).alias("message"))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = {
        "episode_id": json_string(F.concat(F.lit("ep_"), F.sha2(F.col("conv_id").cast("string"), 256))),
        "conversation": arr(F.col("turns.message")),
        "tools": F.lit("[]"),
        "annotations": F.lit("{}"),
        "variant_id": F.lit('"v0"'),
    }
    name = F.concat(F.lit("ep_"), F.sha2(F.col("conv_id").cast("string"), 256))
    return grouped.select("conv_id", name.alias("episode_id"), obj(**parts).alias("episode"))


_TURNS = """
    WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, role, text, 'ep_' || sha256(CAST(conv_id AS VARCHAR)) AS episode_id
               FROM conversations)
"""


@query(_TURNS + f"""
    SELECT conv_id, '/conversation/' || i || '/content' AS json_pointer, length(text) AS n_chars,
           'seg_' || sha256('{{"episode_id":"' || episode_id || '","field_policy_version":"p1","json_pointer":"/conversation/' || i
               || '/content","source_sha256":"sha256:' || sha256({js('text')}) || '"}}') AS segment_id
    FROM t WHERE role IN ('user', 'assistant')""")
def leaf_segments(spark, sf_dir):
    json_tables.register(spark)
    episodes = _conversations(spark, sf_dir).select("conv_id", "episode")
    return spark.sql(
        """SELECT conv_id, json_pointer, CAST(length(source_text) AS BIGINT) AS n_chars, segment_id
           FROM episode_segments(TABLE(SELECT * FROM {episodes}), 'episode', '{{"version": "p1"}}') WHERE code IS NULL""",
        episodes=episodes,
    )


@query(_TURNS + f"""
    SELECT conv_id, CASE WHEN conv_id % 10 <> 0 AND bool_or(role <> 'system') THEN 'sha256:' || sha256('{{"annotations":{{}},"conversation":['
               || string_agg('{{"content":' || {js("CASE WHEN role IN ('user', 'assistant') THEN 'T ' || text ELSE text END")} || ',"role":"' || role || '"}}', ',' ORDER BY i)
               || '],"episode_id":"' || any_value(episode_id) || '","tools":[]}}') WHEN bool_or(role <> 'system') THEN NULL ELSE 'v0' END AS variant_id,
           CASE WHEN conv_id % 10 = 0 AND bool_or(role <> 'system') THEN 'SEGMENT_COVERAGE' END AS code
    FROM t GROUP BY conv_id""")
def merged_variants(spark, sf_dir):
    """Each segment with "T " before it; every tenth conversation gets no targets and fails."""
    episodes = _conversations(spark, sf_dir)
    rows = episodes.where("conv_id % 10 <> 0").select("episode_id", tools.leaf_segments(F.col("episode"), _POLICY).alias("s"))
    each = rows.select("episode_id", F.explode("s.segments").alias("s"))
    targets = each.select("episode_id", "s.segment_id", F.concat(F.lit("T "), F.col("s.source_text")).alias("target_text"))
    made = tools.merge_segments(episodes, targets, _POLICY).join(episodes.select("conv_id", "episode_id"), "episode_id")
    return made.select("conv_id", F.get_json_object("merged", "$.variant_id").alias("variant_id"), "code")


@query("""
    WITH k AS (SELECT doc_id, 'sha256:' || sha256(text) AS s, lang, source, CASE WHEN doc_id % 2 = 0 THEN 'direct_answer' ELSE 'clarification' END AS act FROM documents),
    e AS (
        SELECT s, lang, source, act, min('mem_' || sha256(CAST(doc_id AS VARCHAR))) AS m, min(doc_id % 3) AS lo, max(doc_id % 3) AS hi
        FROM k WHERE doc_id % 4 <> 3 GROUP BY ALL)
    SELECT doc_id, CASE WHEN lo = hi THEN m END AS memory_entry_id, CASE WHEN lo = hi THEN 'target ' || lo END AS target_text, coalesce(lo <> hi, false) AS conflict
    FROM k LEFT JOIN e USING (s, lang, source, act)""")
def memory_lookups(spark, sf_dir):
    """Documents as requests to a memory of themselves; equal texts with other targets conflict, every fourth is revoked."""
    docs, number = table(spark, sf_dir, "documents"), F.col("doc_id")
    key = {
        "segment_source_sha256": sha(F.col("text")),
        "field_policy_version": F.lit("p1"),
        "argument_policy_version": F.lit("a1"),
        "locale_policy_version": F.col("lang"),
        "presented_context_fingerprint": F.col("source"),
        "tool_scope": F.array().cast("array<string>"),
        "decision_action": F.when(number % 2 == 0, "direct_answer").otherwise("clarification"),
    }
    keys = [value.alias(name) for name, value in key.items()]
    entries = docs.select(
        *keys,
        F.concat(F.lit("mem_"), F.sha2(number.cast("string"), 256)).alias("memory_entry_id"),
        F.concat(F.lit("target "), (number % 3).cast("string")).alias("target_text"),
        F.when(number % 4 == 3, "revoked").otherwise("active").alias("state"),
    )
    found = tools.memory_lookup(docs.select("doc_id", *keys), entries)
    return found.select("doc_id", "memory_entry_id", "target_text", "conflict")
