"""Review: verdict rules, findings, worklists for people, and checks of their logs.

Nothing here decides: faults are named, tasks are listed, evidence that contradicts itself
is an error of its id and not a choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jcs import arr, id_of, json_string, obj

#: What a person may decide of a conflict.
DECISIONS = ("keep_left", "keep_right", "keep_both_context_insufficient", "source_error", "policy_variant", "defer")
TASK_VERSION = "review-task-0.1.0"


def verdict_faults(conclusion: Column, findings: Column, reasons: Column) -> Column:
    """Faults of a model's verdict, in order: ``findings`` ids and ``reasons`` are arrays."""
    rules = (
        ((conclusion == "pass") & ((F.size(findings) > 0) | (F.size(reasons) > 0)), "pass_with_findings_or_reasons"),
        ((conclusion == "fail") & ((F.size(findings) == 0) | (F.size(reasons) > 0)), "fail_without_findings_or_with_reasons"),
        ((conclusion == "needs_human_review") & (F.size(reasons) == 0), "review_without_reasons"),
        (~conclusion.isin("pass", "fail", "needs_human_review"), "unknown_conclusion"),
        (findings != F.array_sort(F.array_distinct(findings)), "findings_not_sorted_or_repeated"),
        (reasons != F.array_sort(F.array_distinct(reasons)), "reasons_not_sorted_or_repeated"),
    )
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in rules)))


def finding_counts(verdicts: DataFrame, findings: str = "findings") -> DataFrame:
    """(category, severity, n) over an array column of findings; pairs that do not occur have no row."""
    each = verdicts.select(F.explode(findings).alias("f")).select("f.category", "f.severity")
    return each.groupBy("category", "severity").agg(F.count("*").alias("n"))


def once(evidence: DataFrame, key: str, body: str) -> tuple[DataFrame, DataFrame]:
    """Evidence from several sources once for each key, and the keys whose bodies differ.

    Bodies are compared as canonical JSON by their least and greatest, so a key with very
    many copies is combined before it is shuffled.
    """
    seen = evidence.groupBy(key).agg(F.min(body).alias("least"), F.max(body).alias("most"))
    good = seen.where("least = most").select(key, F.col("least").alias(body))
    return good, seen.where("least <> most").select(key)


def tasks(quarantines: DataFrame, conflicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Open tasks (task_id, task_kind, action, evidence_id, audit_ids) and contradicting ids.

    quarantines: quarantine_id, body; conflicts: conflict_id, body, audit_id (bodies in
    canonical JSON).  The audits that name a conflict are listed in its one task.
    """
    held, bad_held = once(quarantines, "quarantine_id", "body")
    clashing, bad_clashing = once(conflicts, "conflict_id", "body")
    audits = conflicts.groupBy("conflict_id").agg(F.array_sort(F.collect_set("audit_id")).alias("audit_ids"))

    def task(kind: str, action: str, quarantine: Column, candidate: Column, audit_ids: Column) -> Column:
        return id_of(
            "reviewtask",
            obj(
                schema_version=F.lit(f'"{TASK_VERSION}"'), task_kind=F.lit(f'"{kind}"'), reviewer_authority=F.lit('"human"'),
                action=F.lit(f'"{action}"'), canonical_quarantine=quarantine, conflict_candidate=candidate,
                audit_ids=arr(F.transform(audit_ids, json_string)),
            ),
        )

    none = F.array().cast("array<string>")
    kinds = (
        (held, "quarantine_id", "canonical_quarantine", "remediate_canonical_quarantine"),
        (clashing.join(audits, "conflict_id"), "conflict_id", "conflict_adjudication", "submit_conflict_adjudication"),
    )
    made = []
    for rows, key, kind, action in kinds:
        body, null = F.col("body"), F.lit("null")
        ids = none if key == "quarantine_id" else F.col("audit_ids")
        parts = (body, null) if key == "quarantine_id" else (null, body)
        made.append(
            rows.select(
                task(kind, action, *parts, ids).alias("task_id"),
                F.lit(kind).alias("task_kind"),
                F.lit(action).alias("action"),
                F.col(key).alias("evidence_id"),
                ids.alias("audit_ids"),
            )
        )
    bad = bad_held.toDF("evidence_id").unionByName(bad_clashing.toDF("evidence_id"))
    return made[0].unionByName(made[1]), bad


def adjudication_faults(log: DataFrame) -> DataFrame:
    """``log`` with an array of faults for each decision.

    log: sequence, event_id, conflict_id, left_id, right_id, decision, authority, rationale,
    supersedes.  A decision names the one before it for its conflict, or none.
    """
    before = F.lag("event_id").over(Window.partitionBy("conflict_id").orderBy("sequence"))
    rules = (
        (~F.col("supersedes").eqNullSafe(before), "supersedes_other_than_the_current"),
        (F.col("left_id") == F.col("right_id"), "one_episode_twice"),
        (~F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False)), "unknown_decision"),
        (~F.coalesce(F.col("authority") == "human", F.lit(False)), "not_a_person"),
        (F.coalesce("rationale", F.lit("")) == "", "no_rationale"),
    )
    return log.withColumn("faults", F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in rules))))


def human_review_faults(log: DataFrame) -> DataFrame:
    """``log`` (review_id, verdict_id, authority) with an array of faults: one review by a person for a verdict."""
    twice = lambda key: F.count("*").over(Window.partitionBy(key)) > 1
    rules = (
        (twice("review_id"), "review_id_twice"),
        (twice("verdict_id"), "verdict_reviewed_twice"),
        (~F.coalesce(F.col("authority") == "human", F.lit(False)), "not_a_person"),
    )
    return log.withColumn("faults", F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in rules))))


def coverage_faults(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n_left, n_right) of keys that are not exactly once on both sides; none means that the sets are equal."""
    counted = lambda rows, name: rows.groupBy(key).agg(F.count("*").alias(name))
    both = counted(left, "n_left").join(counted(right, "n_right"), key, "full")
    both = both.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_left", "n_right")})
    return both.where("n_left <> 1 or n_right <> 1")


def block_reasons(rows: DataFrame, by: str, reasons: str) -> DataFrame:
    """(by, reasons): the sorted different reasons of each key; keys without one have no row."""
    each = rows.select(by, F.explode(reasons).alias("reason")).distinct()
    return each.groupBy(by).agg(F.array_sort(F.collect_list("reason")).alias("reasons"))


def rank_faults(rows: DataFrame, rank: str, by: str | None = None) -> DataFrame:
    """Keys (or one row) whose ranks are not 1 .. n, each once."""
    # distinct ranks by a sum over a pre-aggregated table: no list of ranks is built
    keys = [by] if by else []
    counted = rows.groupBy(*keys, rank).agg(F.count("*").alias("n"))
    ends = counted.groupBy(*keys).agg(
        F.min(rank).alias("first"), F.max(rank).alias("last"), F.count("*").alias("n_ranks"), F.sum("n").alias("n_rows")
    )
    return ends.where("first <> 1 or last <> n_ranks or n_rows <> n_ranks")
