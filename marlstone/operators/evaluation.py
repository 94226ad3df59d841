"""Judge results: coverage with Wilson intervals, consensus, packages, overlays, costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the two-sided 95 % normal quantile.
Z = 1.959963984540054
#: USD for a million input, cached input and output tokens.
PRICES = (
    ("flash", "0.14", "0.0028", "0.28"),
    ("pro", "0.435", "0.003625", "0.87"),
    ("strong", "2.50", "0.25", "15.00"),
    ("mini", "0.75", "0.075", "4.50"),
)
#: Failures after which the other provider is tried.
FALLBACK_FAILURES = ("http_transient", "malformed_response", "provider_response_invalid", "response_too_large")


def wilson(successes: Column, total: Column) -> dict[str, Column]:
    """proportion, lower and upper bound; null where there is nothing to cover."""
    p, n = successes / total, total.cast("double")
    z2 = Z * Z
    base = 1 + z2 / n
    centre = (p + z2 / (2 * n)) / base
    margin = Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / base
    some = total > 0
    return {
        "proportion": F.when(some, p),
        "wilson_low": F.when(some, F.greatest(F.lit(0.0), centre - margin)),
        "wilson_high": F.when(some, F.least(F.lit(1.0), centre + margin)),
    }


def coverage(requested: DataFrame, verdicts: DataFrame, unit: str, by: list[str]) -> DataFrame:
    """Requested and covered units by ``by``, with the interval of the share covered."""
    known = verdicts.select(unit).distinct().withColumn("_covered", F.lit(1))
    sums = requested.join(known, unit, "left").groupBy(*by).agg(F.count("*").alias("requested"), F.sum(F.coalesce("_covered", F.lit(0))).alias("covered"))
    return sums.withColumns(wilson(F.col("covered"), F.col("requested")))


def outcome_counts(verdicts: DataFrame, conclusion: str, by: list[str]) -> DataFrame:
    """n_pass, n_review, n_fail and n_all by ``by``; another conclusion counts in n_all only."""
    named = {"n_pass": "pass", "n_review": "needs_human_review", "n_fail": "fail"}
    return verdicts.groupBy(*by).agg(*(F.count_if(F.col(conclusion) == value).alias(name) for name, value in named.items()), F.count("*").alias("n_all"))


def report(requested: DataFrame, verdicts: DataFrame, unit: str = "unit_id") -> DataFrame:
    """One row: requested and covered units with their interval, outcomes, and faults of the input (units twice or never asked for).

    verdicts: the unit, verdict_id, conclusion.  Nothing in a report releases anything.
    """
    asked = requested.select(unit).withColumn("_asked", F.lit(1))
    units = asked.groupBy(unit).agg(F.count("*").alias("n_asked"))
    given = verdicts.groupBy(unit).agg(
        F.count("*").alias("n_given"),
        F.count_if(F.col("conclusion") == "pass").alias("p"),
        F.count_if(F.col("conclusion") == "needs_human_review").alias("r"),
        F.count_if(F.col("conclusion") == "fail").alias("f"),
    )
    both = units.join(given, unit, "full")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    sums = both.agg(
        F.count_if(n("n_asked") > 0).alias("requested"),
        F.count_if((n("n_asked") > 0) & (n("n_given") > 0)).alias("covered"),
        *(F.coalesce(F.sum(n(c)), F.lit(0)).alias(name) for c, name in (("p", "n_pass"), ("r", "n_review"), ("f", "n_fail"))),
        F.count_if((n("n_asked") > 1) | (n("n_given") > 1)).alias("n_twice"),
        F.count_if(n("n_asked") == 0).alias("n_not_asked"),
    )
    return sums.withColumns(wilson(F.col("covered"), F.col("requested"))).withColumn("release_allowed", F.lit(False))


def two_judges(mini: Column, strong: Column) -> Column:
    """Both must pass."""
    return F.when((mini == "pass") & (strong == "pass"), "consensus_pass").otherwise("needs_review")


def hierarchical(mini: Column, sampled: Column, strong: Column) -> dict[str, Column]:
    """Who decides, and what: a pass outside the sample stands, all else is the strong judge's."""
    alone = F.coalesce((mini == "pass") & ~sampled, F.lit(False))
    accepted = alone | F.coalesce(strong == "pass", F.lit(False))
    return {
        "decider": F.when(alone, "mini").otherwise("strong"),
        "consensus": F.when(accepted, "accepted_for_review_package").otherwise("needs_review"),
    }


def escalated(mini: Column, sampled: Column) -> Column:
    return F.coalesce(mini != "pass", F.lit(True)) | sampled


def _meeting(mini: DataFrame, strong: DataFrame, key: str, unit: str) -> DataFrame:
    """A row for each unit of either side, and ``faults``: where strong results are not exactly those of the escalated units.

    Both sides are summed by unit first, so a unit with any number of results is one row.
    """
    asked = mini.groupBy(key).agg(
        F.count("*").alias("n_mini"), F.min(F.struct("conclusion", "sampled", unit)).alias("m"), F.min(unit).alias("_asked_low"), F.max(unit).alias("_asked_high"),
    )
    given = strong.groupBy(key).agg(F.count("*").alias("n_strong"), F.min("conclusion").alias("strong"), F.min(unit).alias("_given_low"), F.max(unit).alias("_given_high"))
    both = asked.join(given, key, "full_outer").withColumn("escalated", F.col("m").isNotNull() & escalated(F.col("m.conclusion"), F.col("m.sampled")))
    n_mini, n_strong = (F.coalesce(F.col(n), F.lit(0)) for n in ("n_mini", "n_strong"))
    same = F.col("_asked_low").eqNullSafe(F.col("_given_low")) & F.col("_asked_high").eqNullSafe(F.col("_given_high"))
    rules = (
        ("mini_result_twice", n_mini > 1),
        ("strong_result_missing", F.col("escalated") & (n_strong == 0)),
        ("strong_result_not_escalated", ~F.col("escalated") & (n_strong > 0)),
        ("strong_result_twice", n_strong > 1),
        ("other_evaluation_unit", (n_mini > 0) & (n_strong > 0) & ~same),
    )
    return both.withColumn("faults", F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules))))


def escalation_faults(mini: DataFrame, strong: DataFrame, key: str = "unit_id", unit: str = "unit") -> DataFrame:
    """(key, fault) wherever strong results are not exactly one for each escalated unit, of the same evaluation unit.

    ``mini`` has conclusion (null: unavailable), sampled and the ``unit`` as a comparable value, ``strong``
    conclusion and unit.  Null keys are a unit like others only within one side; no rows give no faults.
    """
    return _meeting(mini, strong, key, unit).select(key, F.explode("faults").alias("fault"))


def decisions(mini: DataFrame, strong: DataFrame, key: str = "unit_id", unit: str = "unit") -> DataFrame:
    """(key, escalation_reason, decider, consensus) by :func:`hierarchical`; the first fault of a unit fails the query."""
    rows = _meeting(mini, strong, key, unit)
    said = F.concat(F.get("faults", 0), F.lit(" at "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    sure = rows.withColumn("escalated", F.when(F.size("faults") > 0, F.raise_error(said).cast("boolean")).otherwise(F.col("escalated")))
    passed = F.coalesce(F.col("m.conclusion") == "pass", F.lit(False))
    reason = F.when(F.col("escalated"), F.when(passed, "pass_sample").otherwise("mini_non_pass"))
    told = hierarchical(F.col("m.conclusion"), F.col("m.sampled"), F.col("strong"))
    return sure.select(key, reason.alias("escalation_reason"), *(value.alias(name) for name, value in told.items()))


def complete_episodes(units: DataFrame, accepted: DataFrame, episode: str, unit: str) -> DataFrame:
    """Episodes all of whose units are accepted, with their number."""
    flags = units.join(accepted.select(unit).distinct().withColumn("_ok", F.lit(True)), unit, "left")
    whole = flags.groupBy(episode).agg(F.bool_and(F.coalesce("_ok", F.lit(False))).alias("whole"), F.count("*").alias("n_units"))
    return whole.where("whole").select(episode, "n_units")


def overlay(parent: DataFrame, recovered: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """``parent`` with the rows of ``recovered`` in their place; keys must be in ``allowed``.

    A recovered key that is not allowed keeps its parent row and is marked refused.
    """
    values = [c for c in parent.columns if c != key]
    new = recovered.select(key, *(F.col(c).alias(f"_{c}") for c in values), F.lit(True).alias("_new"))
    may = allowed.select(key).distinct().withColumn("_may", F.lit(True))
    both = parent.join(new, key, "full_outer").join(may, key, "left")
    use = F.coalesce("_new", F.lit(False)) & F.coalesce("_may", F.lit(False))
    state = F.when(use, "recovered").when(F.coalesce("_new", F.lit(False)), "refused").otherwise("parent")
    return both.select(key, *(F.when(use, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in values), state.alias("origin"))


def cost_lines(attempts: DataFrame, usage: DataFrame, prices: DataFrame) -> DataFrame:
    """One line for each (provider, model) of either table: requests, tokens, estimated USD."""
    keys = ["provider", "model"]
    sent = attempts.groupBy(*keys).agg(F.count_if(F.col("outcome") != "preflight_blocked").alias("requests"))
    tokens = ("input_tokens", "cached_input_tokens", "output_tokens")
    used = usage.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in tokens), F.count("*").alias("_n"))
    lines = sent.join(used, keys, "full_outer").join(F.broadcast(prices), "model", "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    usd = (
        (count("input_tokens") - count("cached_input_tokens")).cast("decimal(20,0)") * F.col("input_usd")
        + count("cached_input_tokens").cast("decimal(20,0)") * F.col("cached_usd")
        + count("output_tokens").cast("decimal(20,0)") * F.col("output_usd")
    )
    return lines.select(
        "provider",
        "model",
        count("requests").alias("requests"),
        *(count(c).alias(c) for c in tokens),
        F.when(F.col("_n") > 0, F.round(usd / 1_000_000, 6)).alias("estimated_usd"),
    )


def needs_fallback(status: Column, failure: Column) -> Column:
    return (status == "research_needed") | ((status == "failed") & F.coalesce(failure.isin(*FALLBACK_FAILURES), F.lit(False)))
