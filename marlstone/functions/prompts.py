"""Prompt bundles: layers in a fixed order, named by their content."""

from __future__ import annotations

import hashlib

from .jcs import stable_id

# The layers' order and versions that are part of ids.
REQUIRED = ("core_contract", "field_policy", "fidelity_contract", "protected_span_contract", "terminology_protocol", "output_contract")
OPTIONAL = "contrastive_examples"
STATES = ("candidate", "validated", "retired")
BUNDLE_VERSION = "prompt-bundle-0.1.1"
OUTPUT_VERSION = "translation-response-0.1.0"
# End of fixed values.


class PromptError(ValueError):
    pass


def bundle(version: str, layers: list[tuple[str, str, str]], state: str = "validated") -> dict:
    """The bundle of (name, version, content) layers, with its id."""
    names = tuple(name for name, _, _ in layers)
    if names not in (REQUIRED, (*REQUIRED, OPTIONAL)):
        raise PromptError("layers are not the required ones in their order")
    if state not in STATES:
        raise PromptError(f"no such state: {state}")
    if not version or not all(v and content for _, v, content in layers):
        raise PromptError("a version or a layer is empty")
    body = {
        "schema_version": BUNDLE_VERSION,
        "prompt_version": version,
        "promotion_status": state,
        "output_schema_version": OUTPUT_VERSION,
        "layers": [
            {"name": n, "version": v, "content": c, "content_sha256": f"sha256:{hashlib.sha256(c.encode()).hexdigest()}"} for n, v, c in layers
        ],
    }
    return {"prompt_id": stable_id("prompt", body), **body}


def from_config(config: dict) -> dict:
    """The bundle of a configuration with prompt_version, promotion_status and [layers.<name>]."""
    layers = config["layers"]
    order = [*REQUIRED, *(name for name in layers if name not in REQUIRED)]
    made = [(name, str(layers[name]["version"]), layers[name]["content"]) for name in order if name in layers]
    return bundle(config["prompt_version"], made, config.get("promotion_status", "validated"))


def system_text(prompt: dict) -> str:
    return "\n\n".join(layer["content"] for layer in prompt["layers"])


def demand_validated(prompt: dict) -> None:
    """Only a validated bundle may be used for a live run."""
    if prompt["promotion_status"] != "validated":
        raise PromptError("the prompt bundle is not validated")
