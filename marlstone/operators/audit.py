"""Exact duplicates, behaviour conflicts, and the index of identities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jcs import arr, id_of, json_string, obj


def stats(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """(kind, name, n_rows): rows of each table by a column, or of the whole table where none is named."""
    out = None
    for kind, (rows, column) in tables.items():
        counted = rows.groupBy(F.col(column).cast("string").alias("name")) if column else rows.groupBy(F.lit(kind).alias("name"))
        label = kind if column else "all"
        part = counted.agg(F.count("*").alias("n_rows")).select(F.lit(label).alias("kind"), "name", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def duplicate_members(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """A row for each member of a group of two or more: its keys, owner (the least) and the group's size.

    No list is built, so a group may hold any share of all rows.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n_members"), F.min(member).alias("owner"))
    return rows.select(*keys, member).join(counted.where("n_members > 1"), keys)


def duplicate_groups(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Groups of two or more members with equal keys: the least is the owner, none is dropped.

    One row lists all members of a group; where groups have no bound, take :func:`duplicate_members`.
    """
    members = duplicate_members(rows, keys, member)
    gathered = members.groupBy(*keys, "owner", "n_members").agg(F.array_sort(F.collect_list(member)).alias("members"))
    aliases = F.slice("members", 2, F.size("members"))
    return gathered.select(*keys, "owner", aliases.alias("aliases"), "n_members")


def behavior_conflicts(found: DataFrame) -> DataFrame:
    """Pairs of different behaviours in one context, left fingerprint first.

    ``found`` has context_fp, behavior_fp, calls_fp, topology, action, episode id ``member``.
    Pairs are formed of behaviours, not of episodes, so copies make none.
    """
    groups = found.groupBy("context_fp", "behavior_fp").agg(
        F.min("calls_fp").alias("calls_fp"),
        F.bool_and(F.col("topology") == "unknown").alias("unknown"),
        F.bool_and(F.col("action") == "tool_call").alias("calling"),
        F.array_sort(F.collect_list("member")).alias("ids"),
    )
    # both sides are one shuffle of one aggregate; a context of one behaviour meets nothing but itself
    left, right = (groups.select(*(F.col(c).alias(f"{side}_{c}" if c != "context_fp" else c) for c in groups.columns)) for side in ("left", "right"))
    pairs = left.join(right, "context_fp").where("left_behavior_fp < right_behavior_fp")
    same = F.col("left_calls_fp") == F.col("right_calls_fp")
    both = lambda c: F.col(f"left_{c}") & F.col(f"right_{c}")
    body = obj(
        ordered_behavior_fingerprints=arr(F.array(json_string(F.col("left_behavior_fp")), json_string(F.col("right_behavior_fp")))),
        presented_context_fingerprint=json_string(F.col("context_fp")),
    )
    return pairs.select(
        id_of("conf", body).alias("conflict_id"),
        "context_fp",
        "left_behavior_fp",
        "right_behavior_fp",
        F.array_join("left_ids", ",").alias("left_ids"),
        F.array_join("right_ids", ",").alias("right_ids"),
        same.alias("call_multiset_same"),
        F.when(same & both("unknown") & both("calling"), "order_ambiguity_review").otherwise("hard_conflict").alias("kind"),
    )


#: What of a written audit names members.
_AUDIT = (
    "audit_id string, duplicate_groups array<struct<owner_episode_id:string,alias_episode_ids:array<string>>>, "
    "conflict_candidates array<struct<conflict_id:string,left_member_episode_ids:array<string>,right_member_episode_ids:array<string>>>"
)


def audit_members(audits: DataFrame, text: str = "value") -> DataFrame:
    """(audit_id, kind, group_id, episode_id) of audits as JSON: kind is conflict, alias or unreadable (with nulls)."""
    read = audits.select(F.from_json(text, _AUDIT).alias("a")).select("a.*")
    whole = F.col("audit_id").isNotNull() & F.col("duplicate_groups").isNotNull() & F.col("conflict_candidates").isNotNull()
    good = read.where(whole)
    clash = good.select("audit_id", F.explode("conflict_candidates").alias("c"))
    clash = clash.select("audit_id", F.lit("conflict").alias("kind"), F.col("c.conflict_id").alias("group_id"),
                         F.explode(F.concat("c.left_member_episode_ids", "c.right_member_episode_ids")).alias("episode_id"))
    alias = good.select("audit_id", F.explode("duplicate_groups").alias("g"))
    alias = alias.select("audit_id", F.lit("alias").alias("kind"), F.col("g.owner_episode_id").alias("group_id"), F.explode("g.alias_episode_ids").alias("episode_id"))
    none = F.lit(None).cast("string")
    bad = read.where(~F.coalesce(whole, F.lit(False))).select("audit_id", F.lit("unreadable").alias("kind"), none.alias("group_id"), none.alias("episode_id"))
    return clash.unionByName(alias).unionByName(bad)


def identities(rows: DataFrame, kinds: list[str], member: str) -> DataFrame:
    """Distinct (identity_type, identity_value, member); nulls are left out."""
    return rows.unpivot([member], kinds, "identity_type", "identity_value").where("identity_value is not null").distinct()


def membership(rows: DataFrame, kinds: list[str], member: str) -> DataFrame:
    """(identity_type, identity_value) to sorted distinct members, one list each; :func:`identities` builds none."""
    long = identities(rows, kinds, member)
    return long.groupBy("identity_type", "identity_value").agg(F.array_sort(F.collect_list(member)).alias("members"))


def no_repeat(rows: DataFrame, seen: DataFrame, kinds: list[str]) -> DataFrame:
    """Rows none of whose identities is in ``seen`` (identity_type, identity_value)."""
    out = rows
    for kind in kinds:
        known = seen.where(F.col("identity_type") == kind).select(F.col("identity_value").alias(kind)).distinct()
        out = out.join(known, kind, "left_anti")
    return out.select(*rows.columns)
