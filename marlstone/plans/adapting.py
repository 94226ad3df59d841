"""Registered queries of source adapters, fallback routes, misfitting evidence and leaf actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.jcs import arr, json_string, obj
from ..operators import evaluation, evidence, tools
from ..sources import adapters
from .reference import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def _adapted(rows, record, name: str):
    made = rows.select("doc_id", adapters.adapt(record, name).alias("a"))
    return made.select("doc_id", "a.source_conversation_id", "a.action", "a.code", "a.pointer")


def _tool(kind: str) -> str:
    return f'{{"name":"f","parameters":{{"type":"dict","properties":{{"n":{{"type":"{kind}"}}}}}}}}'


@query("""
    WITH d AS (SELECT doc_id, doc_id % 5 AS k, doc_id % 7 = 0 AS odd, lang = 'fr' AS bare FROM documents),
    c AS (SELECT doc_id, k, CASE WHEN bare THEN '/question' WHEN k > 2 THEN '/correct_answer' WHEN odd THEN '/tools/0/parameters/properties/n' END AS pointer FROM d)
    SELECT doc_id, CASE WHEN pointer IS NULL THEN 'u' || doc_id END AS source_conversation_id,
           CASE WHEN pointer IS NULL THEN CASE k WHEN 0 THEN 'tool_call' WHEN 1 THEN 'clarification' ELSE 'tool_unavailable' END END AS action,
           CASE WHEN pointer = '/question' THEN 'SOURCE_ADAPTER_MISSING_FIELD' WHEN pointer IS NOT NULL THEN 'SOURCE_ADAPTER_INVALID_FIELD' END AS code, pointer
    FROM c""")
def adapted_benchmark(spark, sf_dir):
    """Labelled decisions with calls, questions and refusals; some without a question, with an unknown label or type."""
    number = F.col("doc_id")
    label = F.when(number % 5 == 0, "tool_call").when(number % 5 == 1, "request_for_info").when(number % 5 == 2, "cannot_answer").otherwise("perhaps")
    answer = F.when(label == "tool_call", F.lit('{"name":"f","arguments":{"n":1}}')).otherwise(F.lit("an answer"))
    tool = F.when(number % 7 == 0, F.lit(_tool("galaxy"))).otherwise(F.lit(_tool("List[int]")))
    answers = F.concat(F.lit("{"), json_string(label), F.lit(":"), json_string(answer), F.lit("}"))
    fields = {"uuid": json_string(F.concat(F.lit("u"), number.cast("string"))), "correct_answer": json_string(label), "answers": answers, "tools": arr(F.array(json_string(tool)))}
    record = F.when(F.col("lang") == "fr", obj(**fields)).otherwise(obj(**fields, question=json_string(F.col("source"))))
    return _adapted(table(spark, sf_dir, "documents"), record, "when2call")


@query("""
    WITH d AS (SELECT doc_id, doc_id % 6 AS k FROM documents)
    SELECT doc_id, k < 4 AS named, CASE k WHEN 0 THEN 'tool_call' WHEN 1 THEN 'clarification' WHEN 2 THEN 'tool_unavailable' WHEN 3 THEN 'clarification' END AS action,
           CASE WHEN k > 3 THEN 'SOURCE_ADAPTER_INVALID_FIELD' END AS code, CASE k WHEN 4 THEN '/chosen_response/content' WHEN 5 THEN '/messages' END AS pointer
    FROM d""")
def adapted_training(spark, sf_dir):
    """Training rows whose chosen response calls, asks, declines or does neither, or that end in a question or without one."""
    kind = F.col("doc_id") % 6
    said = (
        F.when(kind == 0, '<TOOLCALL>[{"name":"f","arguments":{}}]</TOOLCALL>').when(kind == 1, "Could you please provide the date")
        .when(kind == 2, "I am sorry, that is beyond me").otherwise("a plain statement")
    )
    asked = arr(F.array(obj(role=F.lit('"user"'), content=json_string(F.col("source")))))
    last = arr(F.array(obj(role=F.lit('"user"'), content=json_string(F.col("source"))), obj(role=F.lit('"assistant"'), content=F.lit('"Which one do you mean?"'))))
    tool = arr(F.array(json_string(F.lit(_tool("integer")))))
    chosen = obj(role=F.lit('"assistant"'), content=json_string(said))
    record = F.when(kind == 3, obj(messages=last, tools=tool)).when(kind == 5, obj(messages=asked, tools=tool)).otherwise(obj(messages=asked, tools=tool, chosen_response=chosen))
    made = _adapted(table(spark, sf_dir, "documents"), record, "when2call_training")
    return made.select("doc_id", F.coalesce(F.col("source_conversation_id").startswith("when2call-train-"), F.lit(False)).alias("named"), "action", "code", "pointer")


@query("""
    WITH d AS (SELECT doc_id, doc_id % 9 AS k FROM documents),
    s AS (SELECT doc_id, k, CASE k WHEN 0 THEN '{"type":"string"}' WHEN 1 THEN '{"items":{"type":"integer"},"type":"array"}' WHEN 2 THEN '{"additionalProperties":{"type":"number"},"type":"object"}'
                 WHEN 3 THEN '{"items":false,"prefixItems":[{"type":"string"},{"type":"boolean"}],"type":"array"}' WHEN 4 THEN '{"anyOf":[{"type":"integer"},{"type":"null"}]}'
                 WHEN 5 THEN '{"anyOf":[{"type":"integer"},{"type":"string"}]}' WHEN 6 THEN '{"items":{"items":{"type":"string"},"type":"array"},"type":"array","uniqueItems":true}' END AS form FROM d)
    SELECT doc_id, CASE WHEN form IS NOT NULL THEN '[{"function":{"description":null,"name":"f","parameters":{"properties":{"n":' || form || '},'
                   || CASE WHEN k = 0 THEN '' ELSE '"required":["n"],' END || '"type":"object"},"strict":null},"type":"function"}]' END AS tools,
           CASE WHEN form IS NULL THEN '/tools/0/parameters/n' END AS pointer FROM s""")
def typed_parameters(spark, sf_dir):
    """The schemas of nine declared types, two of them outside the grammar."""
    kinds = ["str, optional", "List[int]", "Dict[str, float]", "Tuple[str, bool]", "Optional[int]", "Union[int, str]", "Set[List[str]]", "List[", "galaxy"]
    declared = F.element_at(F.array(*map(F.lit, kinds)), (F.col("doc_id") % 9 + 1).cast("int"))
    listed = arr(F.array(obj(name=F.lit('"f"'), parameters=obj(n=obj(type=json_string(declared))))))
    answers = F.lit('[{"name":"f","arguments":{}}]')
    record = obj(id=F.col("doc_id").cast("string"), query=F.lit('"q"'), tools=json_string(listed), answers=json_string(answers))
    made = table(spark, sf_dir, "documents").select("doc_id", adapters.adapt(record, "xlam60k").alias("a"))
    return made.select("doc_id", "a.tools", "a.pointer")


@query("""
    SELECT event_id, s = 'research_needed' OR (s = 'failed' AND f IN ('http_transient', 'malformed_response')) AS fallback
    FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'research_needed' WHEN 1 THEN 'failed' ELSE 'translated' END AS s,
                 CASE event_type WHEN 'error' THEN 'http_transient' WHEN 'view' THEN 'malformed_response' WHEN 'click' THEN 'network_delivery_unknown' ELSE 'http_permanent' END AS f FROM events)""")
def fallback_routes(spark, sf_dir):
    number, kind = F.col("event_id"), F.col("event_type")
    status = F.when(number % 3 == 0, "research_needed").when(number % 3 == 1, "failed").otherwise("translated")
    failure = F.when(kind == "error", "http_transient").when(kind == "view", "malformed_response").when(kind == "click", "network_delivery_unknown").otherwise("http_permanent")
    return table(spark, sf_dir, "events").select("event_id", evaluation.needs_fallback(status, failure).alias("fallback"))


@query("""
    SELECT l_orderkey AS episode, CAST(l_linenumber AS VARCHAR) AS call_id, 'duplicate' AS problem FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT DISTINCT l_orderkey, CAST(l_linenumber AS VARCHAR), 'unexpected' FROM lineitem WHERE l_linenumber > 4""")
def evidence_misfits(spark, sf_dir):
    """Lines as evidence for the first four calls of each order: some come twice, some for no call."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("episode"), F.col("l_linenumber").cast("string").alias("call_id"), F.lit("/n").alias("argument_pointer"), "l_linenumber"
    )
    expected = lines.where("l_linenumber <= 4").drop("l_linenumber").distinct()
    return evidence.misfits(expected, lines.drop("l_linenumber")).select("episode", "call_id", "problem")


@query(r"""
    WITH t AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'https://x.org/' || event_id WHEN 'view' THEN 'C:\\dir\\' || event_id WHEN 'error' THEN 'plain words ' || event_id
                                    WHEN 'signup' THEN CAST(event_id AS VARCHAR) ELSE '/usr/' || event_id END AS text, event_id % 4 AS k, event_type FROM events)
    SELECT event_id, CASE WHEN k = 1 OR k = 2 OR event_type <> 'error' THEN 'FIELD_POLICY_UNSAFE' END AS code,
           CASE WHEN NOT (k = 1 OR k = 2 OR event_type <> 'error') THEN 1 END AS n_segments
    FROM t""")
def argument_safety(spark, sf_dir):
    """Arguments to translate: addresses, paths, numbers and language, under schemas that are text, number, or a list of values."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    text = (
        F.when(kind == "click", F.concat(F.lit("https://x.org/"), number)).when(kind == "view", F.concat(F.lit("C:\\dir\\"), number))
        .when(kind == "error", F.concat(F.lit("plain words "), number)).when(kind == "signup", number).otherwise(F.concat(F.lit("/usr/"), number))
    )
    residue = F.col("event_id") % 4
    schema = F.when(residue == 1, '{"enum":["a"],"type":"string"}').when(residue == 2, '{"type":"number"}').otherwise(F.lit('{"type":"string"}'))
    tool = obj(function=obj(name=F.lit('"f"'), parameters=obj(properties=obj(n=schema), type=F.lit('"object"'))), type=F.lit('"function"'))
    call = obj(function=obj(arguments=obj(n=json_string(text)), name=F.lit('"f"')), id=F.lit('"c"'), type=F.lit('"function"'))
    turn = obj(content=F.lit("null"), role=F.lit('"assistant"'), tool_calls=arr(F.array(call)))
    episode = obj(annotations=F.lit("{}"), conversation=arr(F.array(turn)), episode_id=F.lit('"e"'), tools=arr(F.array(tool)), variant_id=F.lit('"v"'))
    policy = tools.FieldPolicy("p", arguments={("f", "/n"): tools.TRANSLATE, ("*", "/*"): tools.COPY})
    made = table(spark, sf_dir, "events").select("event_id", tools.leaf_segments(episode, policy).alias("s"))
    return made.select("event_id", "s.code", F.when(F.col("s.code").isNull(), F.size("s.segments")).alias("n_segments"))


@query("""
    SELECT event_id, CASE event_type WHEN 'error' THEN '/conversation/0/role' WHEN 'view' THEN '/' WHEN 'signup' THEN '/tools/0/tool_id' END AS pointer FROM events""")
def preserved_fields(spark, sf_dir):
    """Episodes against their merged forms, in which a role, the shape or a tool's id changed, or only what may."""
    kind = F.col("event_type")

    def episode(content, role, tool_id, doc, more):
        turn = obj(content=json_string(content), role=json_string(role))
        tool = obj(documentation_hash=json_string(doc), tool_id=json_string(tool_id))
        return obj(conversation=F.concat(F.lit("["), turn, more, F.lit("]")), tools=arr(F.array(tool)), variant_id=json_string(doc))

    props, none = F.col("props"), F.lit("")
    before = episode(props, F.lit("user"), F.lit("t"), F.lit("a"), none)
    after = episode(
        F.concat(F.lit("T "), props), F.when(kind == "error", "system").otherwise("user"), F.when(kind == "signup", "u").otherwise("t"), F.lit("b"),
        F.when(kind == "view", ",{}").otherwise(none),
    )
    return table(spark, sf_dir, "events").select("event_id", tools.preserved(before, after, F.array(F.lit("/conversation/0/content"))).alias("pointer"))
