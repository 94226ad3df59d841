"""Episodes: a conversation up to its last assistant turn, with its fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jcs import arr, id_of, json_string, obj, sha


def episodes(turns: DataFrame) -> DataFrame:
    """One row per conversation that has an assistant turn: its context and its answer.

    ``turns`` has conv_id, turn, role, text.  One shuffle, by conversation.
    """
    message = F.struct("turn", "role", "text")
    folded = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(message)).alias("messages"),
        F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("target_turn"),
    )
    context = F.filter("messages", lambda m: m["turn"] < F.col("target_turn"))
    answer = F.element_at(F.filter("messages", lambda m: m["turn"] == F.col("target_turn")), 1)
    return (
        folded.where("target_turn is not null")
        .select("conv_id", "target_turn", context.alias("context"), answer["text"].alias("answer"))
        .withColumn("episode_id", id_of("ep", obj(
            id_version=F.lit("1"),
            source_conversation_id=json_string(F.col("conv_id").cast("string")),
            target_message_index=F.col("target_turn").cast("string"),
        )))
    )


def fingerprints(found: DataFrame) -> DataFrame:
    """``found`` with the digests of what was presented and of what was done."""
    messages = F.transform("context", lambda m: obj(content=json_string(m["text"]), role=json_string(m["role"])))
    behaviour = obj(action=F.lit('"direct_answer"'), calls=F.lit("[]"), content=json_string(F.col("answer")))
    return found.withColumns({"context_fp": sha(arr(messages)), "behavior_fp": sha(behaviour)})
