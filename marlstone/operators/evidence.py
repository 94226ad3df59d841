"""Argument grounding and the translation contract: both judge declared evidence, neither reads meaning into text.

Grounding: every expected argument gets one status; an argument without evidence counts as
origin ``unknown``.  Contract: every requested segment is answered once, in NFC, with its
protected marks each once and in order; the problems found are returned, none means it holds.
Null texts count as empty; a null origin counts as unknown.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the form of a protected mark.
MARK = r"⟪S[1-9][0-9]*_P[1-9][0-9]*⟫"
ARGUMENT = ["episode", "call_id", "argument_pointer"]


def role_at(pointer: Column, roles: Column, target: Column) -> Column:
    """Role of the message before ``target`` into which a pointer leads; null for any other place."""
    part = F.split(pointer, "/")
    index = F.when(F.get(part, F.lit(2)).rlike("^[0-9]+$"), F.get(part, F.lit(2)).try_cast("int"))
    inside = (F.size(part) >= 4) & (F.get(part, F.lit(1)) == "conversation") & (index < target)
    return F.when(inside, F.get(roles, index))


def misfits(expected: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence that is given twice or for no expected argument, with ``problem``; grounding needs none of it."""
    twice = evidence.groupBy(*ARGUMENT).count().where("count > 1").select(*ARGUMENT, F.lit("duplicate").alias("problem"))
    stray = evidence.select(*ARGUMENT).distinct().join(expected.select(*ARGUMENT), ARGUMENT, "left_anti")
    return twice.unionByName(stray.withColumn("problem", F.lit("unexpected")))


def grounding(expected: DataFrame, evidence: DataFrame, contexts: DataFrame) -> DataFrame:
    """``status`` (supported, unsupported, unresolved) and accepted ``origin`` of each expected argument.

    ``evidence`` adds origin, evidence_pointers, input_pointers and resolves (whether all
    pointers find something); ``contexts`` has episode, roles (of all messages) and target.
    """
    rows = expected.select(*ARGUMENT).join(evidence, ARGUMENT, "left").join(contexts.select("episode", "roles", "target"), "episode", "left")
    claimed = F.coalesce("origin", F.lit("unknown"))
    given = F.coalesce(F.when(claimed == "derived", F.col("input_pointers")).otherwise(F.col("evidence_pointers")), F.array().cast("array<string>"))
    met = F.transform(given, lambda p: role_at(p, F.col("roles"), F.col("target")))
    some = F.size(given) > 0

    def only(*names: str) -> Column:
        return F.forall(met, lambda r: F.coalesce(r.isin(*names), F.lit(False)))

    allowed = (
        F.when(claimed == "explicit_user", some & only("user"))
        .when(claimed == "tool_result", some & only("tool"))
        .when(claimed == "system_context", only("system", "developer"))
        .when(claimed.isin("prior_turn", "derived"), some & F.forall(met, lambda r: r.isNotNull()))
        .when(claimed == "deterministic_default", F.forall(given, lambda p: p.startswith("/tools/")))
        .otherwise(F.lit(True))
    ) & F.coalesce("resolves", F.lit(True))
    status = (
        F.when(~allowed | (claimed == "must_not_infer"), "unsupported")
        .when(claimed.isin("unknown", "derived"), "unresolved")
        .otherwise("supported")
    )
    return rows.select(*ARGUMENT, F.when(allowed, claimed).otherwise("unknown").alias("origin"), status.alias("status"))


def diagnostics(grounded: DataFrame) -> DataFrame:
    """A row (episode, code, json_pointer, message) for each argument that is not supported."""
    wrong = grounded.where("status <> 'supported'")
    return wrong.select(
        "episode",
        F.lit("SOURCE_ARG_NOT_GROUNDED").alias("code"),
        F.col("argument_pointer").alias("json_pointer"),
        F.concat(F.lit("call "), "call_id", F.lit(": "), "status", F.lit(" by "), "origin").alias("message"),
    )


def outcomes(grounded: DataFrame) -> DataFrame:
    """One result for each episode: a failure outweighs a review, a review a pass."""
    failed = F.bool_or(F.col("status") == "unsupported")
    open_ = F.bool_or(F.col("status") == "unresolved")
    result = F.when(failed, "deterministic_fail").when(open_, "needs_semantic_review").otherwise("deterministic_pass")
    return grounded.groupBy("episode").agg(F.count("*").alias("n_arguments"), result.alias("result"))


@F.pandas_udf(T.BooleanType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t is None or unicodedata.is_normalized("NFC", t))


def contract_problems(requested: DataFrame, answered: DataFrame) -> DataFrame:
    """(request_id, segment_id, problem) of the segments whose answers break the contract.

    ``requested`` has source_text, ``answered`` target_text; both have request_id and segment_id.
    """
    key = ["request_id", "segment_id"]
    left = requested.select(*key, F.coalesce("source_text", F.lit("")).alias("_source"))
    right = answered.select(*key, F.coalesce("target_text", F.lit("")).alias("_target"))
    both = left.join(right, key, "full_outer").withColumn("_nfc", _composed("_target"))

    def marks(text: str) -> Column:
        return F.regexp_extract_all(text, F.lit(MARK), F.lit(0))

    problem = (
        F.when(F.col("_target").isNull(), "missing")
        .when(F.col("_source").isNull(), "extra")
        .when(~F.col("_nfc"), "not_composed")
        .when(marks("_source") != marks("_target"), "protected_marks")
        .when(F.size(F.array_distinct(marks("_source"))) < F.size(marks("_source")), "protected_marks")
    )
    return both.select(*key, problem.alias("problem")).where("problem is not null")
