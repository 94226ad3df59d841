"""An append-only log of chained events: one file for each, named by its number and its content.

An append reads the chain, and creates the next file by an exclusive write; of two writers
that want the same number one fails.  Reading as a table, for ``ledger`` to check, is Spark's.
"""

from __future__ import annotations

import os
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jcs import canonical, digest
from ..functions.strict_json import loads

#: Fixed value: a version that is part of ids.
EVENT_VERSION = "run-event-0.1.0"
SCHEMA = (
    "event_id string, event_hash string, previous_event_hash string, sequence long, timestamp_utc string, run_id string, stage string, "
    "event_type string, parent_manifest_id string"
)


class LogError(ValueError):
    pass


def utc_text(moment: datetime) -> str:
    """A moment in UTC with microseconds and a Z."""
    return moment.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def read(root: str) -> list[dict]:
    """The verified events in order; LogError at the first that breaks the chain."""
    out: list[dict] = []
    for name in sorted(os.listdir(root) if os.path.isdir(root) else []):
        if not name.endswith(".jsonl"):
            continue
        with open(os.path.join(root, name), "rb") as file:
            lines = file.read().split(b"\n")
        event = loads(lines[0]) if len(lines) == 2 and not lines[1] else None
        body = {k: v for k, v in event.items() if k not in ("event_id", "event_hash")} if isinstance(event, dict) else {}
        own = digest(body)
        if not body or event.get("event_hash") != own or event.get("event_id") != "evt_" + own.removeprefix("sha256:"):
            raise LogError(f"{name}: not the event that it says it is")
        if event["sequence"] != len(out) + 1 or event["previous_event_hash"] != (out[-1]["event_hash"] if out else None):
            raise LogError(f"{name}: does not follow from the event before it")
        out.append(event)
    return out


def append(root: str, run_id: str, stage: str, event_type: str, details: dict, parent: str | None = None, moment: datetime | None = None) -> dict:
    """Add an event after the last one."""
    events = read(root)
    body = {
        "schema_version": EVENT_VERSION,
        "previous_event_hash": events[-1]["event_hash"] if events else None,
        "sequence": len(events) + 1,
        "timestamp_utc": utc_text(moment or datetime.now(UTC)),
        "run_id": run_id,
        "stage": stage,
        "event_type": event_type,
        "parent_manifest_id": parent,
        "details": details,
    }
    own = digest(body)
    event = {**body, "event_hash": own, "event_id": "evt_" + own.removeprefix("sha256:")}
    os.makedirs(root, exist_ok=True)
    # the number alone is the name that only one writer can create; the content's name is linked to it after
    claim = os.path.join(root, f"{event['sequence']:012d}.claim")
    try:
        with open(claim, "x", encoding="utf-8"):
            pass
    except FileExistsError as error:
        raise LogError(f"event {event['sequence']} is being written by another") from error
    path = os.path.join(root, f"{event['sequence']:012d}-{event['event_id']}.jsonl")
    with open(path + ".part", "x", encoding="utf-8", newline="") as file:
        file.write(canonical(event) + "\n")
    os.rename(path + ".part", path)
    return event


def adjudicate(root: str, run_id: str, decision: dict, decisions: tuple[str, ...]) -> dict:
    """Append a person's decision of a conflict, which names the one before it or none."""
    before = [e for e in read(root) if e["details"].get("conflict_id") == decision["conflict_id"]]
    rules = (
        (decision.get("supersedes_event_id") != (before[-1]["event_id"] if before else None), "it must name the decision that it supersedes"),
        (decision.get("left_episode_id") == decision.get("right_episode_id"), "it needs two episodes"),
        (decision.get("decision") not in decisions, "no such decision"),
        (decision.get("reviewer_authority") != "human", "only a person decides"),
        (not decision.get("rationale"), "a rationale is needed"),
    )
    if faults := [text for test, text in rules if test]:
        raise LogError("; ".join(faults))
    return append(root, run_id, "adjudication", "conflict_adjudicated", decision)


def table(spark: SparkSession, root: str) -> DataFrame:
    """The log's events as rows, unverified, with their details as JSON."""
    lines = spark.read.option("pathGlobFilter", "*.jsonl").text(root)
    event = F.from_json("value", SCHEMA + ", details string")
    return lines.select(event.alias("e")).select("e.*")
