"""Deterministic stratified ranking, tiers, cohorts, greedy budgets and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jcs import json_string, obj, sha
from .common import settled

#: Tier names and sizes.
TIERS = (("S30", 30), ("S100", 100), ("S250", 250), ("S400", 400))
POLICY = "selection-policy-0.1.0"


def ordered_rank(df: DataFrame, order: list[str], out: str = "rank") -> DataFrame:
    """``df`` with global ranks 1.. by ``order``, without one task for all rows.

    Rows are dealt by ranges; ranks inside a range are added to the rows before it.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    # settled: both uses below must see the same ranges
    inside = settled(parts.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order))))
    sizes = inside.groupBy("_part").agg(F.max("_in").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = inside.join(F.broadcast(before.select("_part", "_before")), "_part")
    return joined.withColumn(out, (F.col("_before") + F.col("_in")).cast("long")).drop("_part", "_in", "_before")


def keys(df: DataFrame, member: str, stratum: dict[str, Column]) -> DataFrame:
    """``df`` with the stratum's key and the row's rank key."""
    body = obj(**stratum)
    rank = obj(policy=json_string(F.lit(POLICY)), episode_id=json_string(F.col(member)), stratum=body)
    return df.withColumns({"stratum_key": sha(obj(policy=json_string(F.lit(POLICY)), stratum=body)), "rank_key": sha(rank)})


def round_robin(df: DataFrame, member: str, out: str = "rank") -> DataFrame:
    """Depth 0 of every stratum in key order, then depth 1, and so on: one global rank.

    A stratum of any size spans several ranges of (stratum, rank key): its rows' depths are
    their ranks inside the range and the rows of the stratum in the ranges before it.
    """
    order = ["stratum_key", "rank_key", member]
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    inside = settled(parts.withColumn("_in", F.row_number().over(Window.partitionBy("_part", "stratum_key").orderBy("rank_key", member))))
    # one row for each stratum of a range
    sizes = inside.groupBy("stratum_key", "_part").agg(F.max("_in").alias("_n"))
    earlier = Window.partitionBy("stratum_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("stratum_key", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    deep = inside.join(before, ["stratum_key", "_part"]).withColumn("depth", (F.col("_before") + F.col("_in") - 1).cast("long"))
    return ordered_rank(deep.drop("_part", "_in", "_before"), ["depth", "stratum_key"], out)


def exclusion_reasons(verdict: Column, adjudicated: Column, conflict: Column, grounding: Column) -> Column:
    """Why a candidate cannot be frozen, in fixed order; empty where it can."""
    tests = (
        (verdict != "source_valid", "source_not_valid"),
        (~adjudicated, "not_human_adjudicated"),
        (conflict, "unresolved_hard_conflict"),
        (F.array_contains(grounding, "unknown"), "unknown_grounding"),
        (F.array_contains(grounding, "must_not_infer"), "must_not_infer_grounding"),
    )
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in tests)))


def tiers(ranked: DataFrame, member: str, sizes=TIERS) -> DataFrame:
    """(tier, rank, member): prefixes of the frozen order."""
    names = F.array(*(F.when(F.col("rank") <= n, F.lit(name)) for name, n in sizes))
    return ranked.select(F.explode(F.array_compact(names)).alias("tier"), "rank", member)


def cohort(df: DataFrame, namespace: str, order: list[str], offset: int, limit: int) -> DataFrame:
    """Round-robin over namespaces; rows offset + 1 .. offset + limit of it."""
    depth = F.row_number().over(Window.partitionBy(namespace).orderBy(*order))
    need = offset + limit  # no namespace can give more than that
    near = df.withColumn("depth", depth.cast("long")).where(F.col("depth") <= need)
    rank = F.row_number().over(Window.orderBy("depth", namespace))
    return near.withColumn("rank", rank.cast("long")).where(F.col("rank").between(offset + 1, need))


def greedy_budget(df: DataFrame, order: str, cost: str, member: str, budget: int, limit: int) -> DataFrame:
    """Members in order, skipping those that do not fit, until ``limit`` are taken.

    What did not fit once never fits later, as the budget only shrinks.  So the first
    ``limit`` candidates after the last one taken that fit now are all that is looked at
    (a bounded top-k of the table); where one of them stops fitting, the next ones are asked for.
    """
    spark = df.sparkSession
    rows = settled(df.select(F.col(order).alias("o"), F.col(cost).cast("long").alias("c"), F.col(member).alias("m")).where("c is not null"))
    kinds = [kind for _, kind in rows.select("o", "m").dtypes]
    taken: list[tuple] = []
    left, last = budget, None
    while len(taken) < limit:
        fits = rows.where(F.col("c") <= left)
        if last is not None:
            fits = fits.where(F.struct("o", "m") > F.struct(*(F.lit(x).cast(kind) for x, kind in zip(last, kinds, strict=True))))
        some = fits.orderBy("o", "m").limit(limit).collect()
        for row in some:
            last = (row.o, row.m)
            if row.c <= left and len(taken) < limit:
                left -= row.c
                taken.append((len(taken) + 1, row.m))
        if len(some) < limit:
            break
    return spark.createDataFrame(taken, f"rank long, {member} {dict(df.dtypes)[member]}")


#: Policy versions in rank keys, by the key's name.
RANK_POLICIES = {"candidate_policy_version": "autonomous-candidate-0.1.1", "canary_policy_version": "pre-review-canary-0.1.0"}


def cohort_key(policy: str, episode: Column, variant: Column) -> Column:
    """Rank key of an episode and its variant under a policy named in RANK_POLICIES."""
    version = json_string(F.lit(RANK_POLICIES[policy]))
    return sha(obj(**{policy: version, "episode_id": json_string(episode), "input_variant_id": json_string(variant)}))


def eligible(episodes: DataFrame, conflicts: DataFrame, aliases: DataFrame, member: str = "episode_id") -> DataFrame:
    """Unreviewed episodes of explicit evidence that are in no conflict and no alias of another.

    conflicts and aliases have a row for each member: two anti joins, no list.
    """
    fit = episodes.where("quality_state = 'unreviewed' and evidence_status = 'source_explicit'")
    for out in (conflicts, aliases):
        fit = fit.join(out.select(member).distinct(), member, "left_anti")
    return fit


class SelectionError(ValueError):
    pass


def automation_cohort(
    df: DataFrame, namespace: str, order: list[str], segments: str, n: int, budget: int, offset: int = 0
) -> DataFrame:
    """``n`` rows by round-robin over namespaces after ``offset`` rows; rows without segments do not count.

    Fails where too few are left or their segments pass the budget.  Of a namespace only
    the first offset + n rows can be chosen, which each input partition finds for itself
    before anything is shuffled.
    """
    if not 1 <= n <= 1000 or budget < 1 or offset < 0:
        raise SelectionError("n must be 1 to 1000, the budget positive, the offset not negative")
    chosen = settled(cohort(df.where(F.col(segments) > 0), namespace, order, offset, n).withColumn("rank", F.col("rank") - offset))
    count, total = chosen.agg(F.count("*"), F.coalesce(F.sum(segments), F.lit(0))).first()
    if count < n:
        raise SelectionError(f"{count} rows left of the {n} asked for")
    if total > budget:
        raise SelectionError(f"{total} segments pass the budget of {budget}")
    return chosen


def frozen(queue: DataFrame, member: str, n: int = 400) -> DataFrame:
    """(rank, reserve_rank, member): the first ``n`` of the ranked queue without a reason against them.

    queue: rank, member, reasons (array).  Fails where there are fewer.
    """
    fit = queue.where(F.size("reasons") == 0).orderBy("rank").limit(n)
    rank = F.row_number().over(Window.orderBy("rank"))  # over n rows
    out = settled(fit.select(rank.cast("long").alias("rank"), F.col("rank").alias("reserve_rank"), member))
    if (found := out.count()) < n:
        raise SelectionError(f"a freeze needs {n} candidates without a reason against them; there are {found}")
    return out


def in_sample(unit: Column, basis_points: int) -> Column:
    """Deterministic share of units, by the first 32 bits of their digest."""
    return F.conv(F.substring(F.sha2(unit, 256), 1, 8), 16, 10).cast("long") % 10_000 < basis_points
