"""Append-only logs: chain checks, latest records, human acceptance, loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IGNORED = -100


def verify_chain(log: DataFrame, by: str, sequence: str, digest: str, previous: str) -> DataFrame:
    """Each record with whether its number and its link follow from the one before."""
    order = Window.partitionBy(by).orderBy(sequence)
    number = F.row_number().over(order)
    before = F.lag(digest).over(order)
    return log.withColumns({
        "sequence_ok": F.col(sequence) == number,
        "link_ok": F.col(previous).eqNullSafe(before),
    })


def latest(log: DataFrame, by: str, sequence: str) -> DataFrame:
    """The last record of each key."""
    last = log.groupBy(by).agg(F.max_by(F.struct(*log.columns), sequence).alias("_row"))
    return last.select("_row.*")


def supersedes_ok(log: DataFrame, by: str, sequence: str, event: str, supersedes: str) -> DataFrame:
    """Each decision with whether it names the one before it for its key (none: null)."""
    before = F.lag(event).over(Window.partitionBy(by).orderBy(sequence))
    return log.withColumn("supersedes_ok", F.col(supersedes).eqNullSafe(before))


def gold_state(decision: Column, review_verdict: Column, verdict: Column, findings: Column, reviewed: Column) -> Column:
    """pending, error, human_accepted or human_rejected: only a human review makes gold."""
    unknown = F.size(F.array_except(reviewed, findings)) > 0
    missed = F.size(F.array_except(findings, reviewed)) > 0
    return (
        F.when(decision.isNull(), "pending_human_review")
        .when(review_verdict != verdict, "error")
        .when(unknown, "error")
        .when((decision == "accept") & missed, "error")
        .when(decision == "accept", "human_accepted")
        .otherwise("human_rejected")
    )


def loss_labels(ids: Column, start: Column, end: Column) -> Column:
    """Ids inside [start, end), the ignored label elsewhere."""
    return F.transform(ids, lambda x, i: F.when((i >= start) & (i < end), x).otherwise(F.lit(IGNORED).cast("int")))
