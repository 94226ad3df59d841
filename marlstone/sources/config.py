"""Configuration files (TOML), checked as a whole before anything runs."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass

from ..operators.tools import COPY, IF_NATURAL, TRANSLATE, FieldPolicy


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Pipeline:
    max_record_bytes: int = 8 << 20
    shard_rows: int = 10_000
    providers_enabled: bool = False
    egress_enabled: bool = False


@dataclass(frozen=True)
class Similarity:
    n: int
    threshold: float
    membership: int
    tiers: tuple[int, ...]


def _known(table: dict, names: set[str], where: str) -> dict:
    if unknown := sorted(set(table) - names):
        raise ConfigError(f"{where}: no such setting {', '.join(unknown)}")
    return table


def _whole(table: dict, name: str, default: int, low: int = 1) -> int:
    value = table.get(name, default)
    if not isinstance(value, int) or isinstance(value, bool) or value < low:
        raise ConfigError(f"{name} must be a whole number of at least {low}")
    return value


def pipeline(text: str) -> Pipeline:
    """Limits and gates; every gate is shut unless it is opened by name."""
    table = tomllib.loads(text)
    versions = {"schema_version", "canonical_schema_version", "diagnostic_catalog_version", "normalizer_version"}
    _known(table, versions | {"max_record_bytes", "jsonl_shard_rows", "providers"}, "pipeline")
    gates = table.get("providers", {})
    for name in ("enabled", "network_egress_enabled"):
        if not isinstance(gates.get(name, False), bool):
            raise ConfigError(f"{name} must be true or false")
    return Pipeline(
        _whole(table, "max_record_bytes", 8 << 20), _whole(table, "jsonl_shard_rows", 10_000),
        gates.get("enabled", False), gates.get("network_egress_enabled", False),
    )


def token_budgets(text: str) -> list[tuple[str, int]]:
    """(model, daily_token_budget) of the providers that have one."""
    tables = [t for t in tomllib.loads(text).get("providers", {}).values() if isinstance(t, dict)]
    return [(t["model"], _whole(t, "daily_token_budget", 1)) for t in tables if "daily_token_budget" in t]


def similarity(text: str) -> Similarity:
    """Candidates are looked for, nothing is dropped by itself, and people decide."""
    table = tomllib.loads(text)
    n, threshold = _whole(table, "ngram_size", 3), table.get("near_duplicate_candidate_threshold", 0.82)
    tiers = tuple(table.get("selection_tiers", ()))
    if n > 8:
        raise ConfigError("ngram_size must be 1 to 8")
    if not isinstance(threshold, int | float) or not 0 <= threshold <= 1:
        raise ConfigError("the threshold must be 0 to 1")
    if table.get("automatic_similarity_drop", False) or not table.get("human_adjudication_required", True):
        raise ConfigError("similarity never drops anything by itself")
    if tiers != (30, 100, 250, 400):
        raise ConfigError("the tiers are 30, 100, 250 and 400")
    return Similarity(n, float(threshold), _whole(table, "required_source_valid_membership", 400), tiers)


def field_policy(text: str) -> FieldPolicy:
    table = _known(
        tomllib.loads(text),
        {"schema_version", "policy_version", "tool_description_action", "parameter_description_action", "argument_policies"},
        "field policy",
    )
    actions = {COPY, TRANSLATE, IF_NATURAL}
    about = {name: table.get(name, IF_NATURAL) for name in ("tool_description_action", "parameter_description_action")}
    if not set(about.values()) <= actions or not table.get("policy_version"):
        raise ConfigError("a version and known actions are needed")
    arguments = {}
    for entry in table.get("argument_policies", []):
        key = entry["tool_name"], entry["argument_pointer"]
        if key in arguments or entry["action"] not in actions:
            raise ConfigError(f"{key} is given twice or with an unknown action")
        arguments[key] = entry["action"]
    return FieldPolicy(
        table["policy_version"], tool_description=about["tool_description_action"],
        parameter_description=about["parameter_description_action"], arguments=arguments,
    )
