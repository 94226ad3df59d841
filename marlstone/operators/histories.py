"""Whole histories of tool-calling episodes: message rules, calls and results, fingerprints.

``turns`` has a row for each message: episode_id, position, role, content, calls (array of
struct id, name, arguments as canonical JSON), call_id, name.  ``tools`` has a row for each
presented tool: episode_id, position, name, tool_id, documentation_hash; without a column
episode_id, the few tools are those of every episode.  All work is keyed
by episode (or by call in an episode); no list is longer than one episode's.

Defined results: a null role is a fault; null or empty calls are no calls; an episode
without turns does not occur; one message may have several faults, each a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jcs import arr, json_string, obj, sha

#: The roles of messages.
ROLES = ("system", "developer", "user", "assistant", "tool")


def _has_calls() -> Column:
    return F.coalesce(F.size("calls") > 0, F.lit(False))


def message_faults(turns: DataFrame) -> DataFrame:
    """(episode_id, position, fault) of messages whose fields do not fit their role."""
    asks = F.col("role").isin("system", "developer", "user")
    answers, results = F.col("role") == "assistant", F.col("role") == "tool"
    rules = {
        "unknown_role": F.col("role").isNull() | ~F.col("role").isin(*ROLES),
        "call_fields_on_prompt": asks & (F.col("calls").isNotNull() | F.col("call_id").isNotNull() | F.col("name").isNotNull()),
        "result_fields_on_answer": answers & (F.col("call_id").isNotNull() | F.col("name").isNotNull()),
        "empty_answer": answers & ~_has_calls() & F.col("content").isNull(),
        "incomplete_result": results & (F.col("content").isNull() | (F.coalesce("call_id", F.lit("")) == "")),
        "calls_on_result": results & F.col("calls").isNotNull(),
    }
    found = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return turns.select("episode_id", "position", F.explode(found).alias("fault"))


def _calls(turns: DataFrame) -> DataFrame:
    made = turns.where((F.col("role") == "assistant") & _has_calls()).select("episode_id", "position", F.posexplode("calls").alias("at", "call"))
    return made.select("episode_id", "position", "at", "call.*")


def call_faults(turns: DataFrame, tools: DataFrame) -> DataFrame:
    """(episode_id, position, fault) of calls and results that do not follow from what was before.

    A call's id is new in its episode and its name is that of exactly one tool; a result
    answers an earlier call that has no result yet, under that call's name where it has one.
    """
    calls = _calls(turns)
    again = F.row_number().over(Window.partitionBy("episode_id", "id").orderBy("position", "at")) > 1
    by = ["episode_id", "name"] if "episode_id" in tools.columns else ["name"]
    named = tools.groupBy(*by).agg(F.count("*").alias("n_tools"))
    resolved = calls.withColumn("again", again).join(named if "episode_id" in by else F.broadcast(named), by, "left")
    bad_calls = F.array_compact(
        F.array(
            F.when(F.col("again"), "call_id_repeated"),
            F.when(F.coalesce("n_tools", F.lit(0)) != 1, "tool_name_unresolved"),
        )
    )
    opened = calls.groupBy("episode_id", F.col("id").alias("call_id")).agg(
        F.min("position").alias("opened_at"), F.min_by("name", "position").alias("opened_as")
    )
    results = turns.where("role = 'tool'").select("episode_id", "position", "call_id", "name").join(opened, ["episode_id", "call_id"], "left")
    late = F.coalesce(F.col("opened_at") < F.col("position"), F.lit(False))
    # only results after the call count: an orphan does not use the call up
    order = Window.partitionBy("episode_id", "call_id", "late").orderBy("position")
    results = results.withColumn("late", late).withColumn("n", F.row_number().over(order))
    bad_results = F.array_compact(
        F.array(
            F.when(~F.col("late") | (F.col("n") > 1), "orphan_or_repeated_result"),
            F.when(F.col("late") & (F.col("n") == 1) & (F.col("name") != F.col("opened_as")), "result_name_differs"),
        )
    )
    return resolved.select("episode_id", "position", F.explode(bad_calls).alias("fault")).unionByName(
        results.select("episode_id", "position", F.explode(bad_results).alias("fault"))
    )


def ending_faults(turns: DataFrame) -> DataFrame:
    """(episode_id, position, fault) of episodes that do not end in a target that fits.

    The last message is an assistant's.  If it calls, it says nothing else; if it does not,
    it has text, and every call before it has its result.
    """
    calls = _calls(turns).select("episode_id", F.col("id").alias("call_id")).distinct()
    answered = turns.where("role = 'tool'").select("episode_id", "call_id").distinct()
    still = calls.join(answered, ["episode_id", "call_id"], "left_anti").groupBy("episode_id").agg(F.count("*").alias("n_open"))
    ends = turns.groupBy("episode_id").agg(F.max_by(F.struct("position", "role", "content", "calls"), "position").alias("end")).select("episode_id", "end.*")
    ends = ends.join(still, "episode_id", "left")
    still_open = F.coalesce("n_open", F.lit(0)) > 0
    found = F.array_compact(
        F.array(
            F.when(F.coalesce(F.col("role") != "assistant", F.lit(True)), "target_not_assistant"),
            F.when((F.col("role") == "assistant") & _has_calls() & F.col("content").isNotNull(), "call_target_with_text"),
            F.when((F.col("role") == "assistant") & ~_has_calls() & F.col("content").isNull(), "text_target_without_text"),
            F.when((F.col("role") == "assistant") & ~_has_calls() & still_open, "open_calls_at_end"),
        )
    )
    return ends.select("episode_id", "position", F.explode(found).alias("fault"))


def history_faults(turns: DataFrame, tools: DataFrame) -> DataFrame:
    """All faults of :func:`message_faults`, :func:`call_faults` and :func:`ending_faults`."""
    return message_faults(turns).unionByName(call_faults(turns, tools)).unionByName(ending_faults(turns))


# -- fingerprints --------------------------------------------------------------------
def _behaviour(call: Column) -> Column:
    return obj(arguments=call["arguments"], name=json_string(call["name"]))


def message_json(m: Column) -> Column:
    """Canonical JSON of a message with all of its fields, absent ones as null."""
    body = lambda c: obj(
        function=obj(arguments=c["arguments"], name=json_string(c["name"])), id=json_string(c["id"]), type=F.lit('"function"')
    )
    calls = F.when(m["calls"].isNull(), F.lit("null")).otherwise(arr(F.transform(m["calls"], body)))
    null = F.lit("null")
    return obj(
        content=json_string(m["content"]), images=null, name=json_string(m["name"]), reasoning_content=null,
        role=json_string(m["role"]), thinking=null, tool_call_id=json_string(m["call_id"]), tool_calls=calls,
    )


def fingerprints(turns: DataFrame, tools: DataFrame) -> DataFrame:
    """episode_id, action, and the fingerprints of context (two), behaviour and call multiset.

    The target is the last message.  ``structural_fp`` takes the tools as a set of ids,
    ``context_fp`` as they were presented, with their documentation.
    """
    whole = F.struct("position", "role", "content", "calls", "call_id", "name")
    folded = turns.groupBy("episode_id").agg(F.sort_array(F.collect_list(whole)).alias("messages"))
    listed = F.sort_array(F.collect_list(F.struct("position", "tool_id", "documentation_hash"))).alias("shown")
    ids = arr(F.array_sort(F.transform("shown", lambda t: json_string(t["tool_id"]))))
    presented = arr(F.transform("shown", lambda t: obj(documentation_hash=json_string(t["documentation_hash"]), tool_id=json_string(t["tool_id"]))))
    if "episode_id" in tools.columns:
        shown = tools.groupBy("episode_id").agg(listed)
        rows = folded.join(shown, "episode_id", "left").withColumn("shown", F.coalesce("shown", F.array().cast(dict(shown.dtypes)["shown"])))
        rows = rows.withColumns({"ids": ids, "presented": presented})
    else:
        rows = folded.crossJoin(F.broadcast(tools.agg(listed).select(ids.alias("ids"), presented.alias("presented"))))
    rows = rows.withColumn("target", F.element_at("messages", -1)).withColumn(
        "calls", F.coalesce(F.col("target")["calls"], F.array().cast("array<struct<id:string,name:string,arguments:string>>"))
    )
    before = F.slice("messages", 1, F.size("messages") - 1)
    prefix = F.when(F.size("messages") < 2, F.lit("[]")).otherwise(arr(F.transform(before, message_json)))
    action = F.when(F.size("calls") > 0, "tool_call").otherwise("direct_answer")
    behaviours = F.transform("calls", _behaviour)
    return rows.select(
        "episode_id",
        action.alias("action"),
        sha(obj(conversation_prefix=prefix, tool_ids=F.col("ids"))).alias("structural_fp"),
        sha(obj(conversation_prefix=prefix, presented_tools=F.col("presented"))).alias("context_fp"),
        sha(obj(action=json_string(action), calls=arr(behaviours), content=json_string(F.col("target")["content"]))).alias("behavior_fp"),
        sha(arr(F.array_sort(behaviours))).alias("calls_fp"),
    )


def technical_structure(turns: DataFrame, tools: DataFrame) -> DataFrame:
    """episode_id and the hash of all that is not language: roles, calls, results, tools (as JSON in ``tool``)."""
    body = lambda c: obj(
        function=obj(arguments=c["arguments"], name=json_string(c["name"])), id=json_string(c["id"]), type=F.lit('"function"')
    )
    calls = F.when(F.col("calls").isNull(), F.lit("null")).otherwise(arr(F.transform("calls", body)))
    message = obj(images=F.lit("null"), name=json_string(F.col("name")), role=json_string(F.col("role")), tool_call_id=json_string(F.col("call_id")), tool_calls=calls)
    folded = turns.select("episode_id", "position", message.alias("m")).groupBy("episode_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "m"))).alias("ms"), F.max("position").alias("last")
    )
    shown = tools.groupBy("episode_id").agg(F.array_sort(F.collect_list(F.struct("position", "tool"))).alias("ts"))
    rows = folded.join(shown, "episode_id", "left")
    listed = F.when(F.col("ts").isNull(), F.lit("[]")).otherwise(arr(F.col("ts.tool")))
    return rows.select(
        "episode_id",
        sha(obj(conversation=arr(F.col("ms.m")), target_message_index=F.col("last").cast("string"), tools=listed)).alias("structure_sha256"),
    )


def lookup(tables: dict[str, tuple[DataFrame, list[str]]], value: str) -> DataFrame | None:
    """The first row, of the first table that has one, with ``value`` in one of its id columns."""
    for rows, columns in tables.values():
        match = F.lit(False)
        for column in columns:
            match = match | F.coalesce(F.col(column) == value, F.lit(False))
        found = rows.where(match).limit(1)
        if not found.isEmpty():
            return found
    return None
