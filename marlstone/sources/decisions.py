"""Adapters of decision records: a labelled benchmark, and training rows with or without a chosen answer."""

from __future__ import annotations

import re

from ..functions import strict_json
from ..functions.jcs import canonical, digest
from .adapter_base import INVALID, AdapterError, demand, filled, text_field, turn

# Labels, type names, phrases and formats of the source data.
LABELS = {"tool_call": "tool_call", "request_for_info": "clarification", "cannot_answer": "tool_unavailable"}
TYPE_NAMES = {
    "array": "array", "boolean": "boolean", "bool": "boolean", "dict": "object", "dictionary": "object", "float": "number",
    "integer": "integer", "int": "integer", "number": "number", "object": "object", "str": "string", "string": "string",
}
ARRAY_NAME = re.compile(r"(?:list|set|tuple)(?:\[.*\])?", re.IGNORECASE)
OBJECT_NAME = re.compile(r"(?:dict|mapping)(?:\[.*\])?", re.IGNORECASE)
ASKS = (
    r"\b(?:could|can|would|will|may) you (?:please )?(?:provide|specify|share|tell|give|confirm|clarify|supply)\b",
    r"\b(?:please|kindly) (?:provide|specify|share|tell|give|confirm)\b",
    r"\b(?:which|what|where|when|who|how many|how much)\b.*\?",
    r"\b(?:i(?:'ll| will)|i) need (?:to know|more|the following)\b",
    r"\b(?:missing|additional|more) (?:information|details?)\b",
)
DECLINES = (
    r"\b(?:apolog(?:y|ies|ize)|sorry|unable|cannot|can't|do not have|don't have|"
    r"not (?:able|capable)|no (?:access|capability)|cannot perform)\b"
)
CALL_MARKS = re.compile(r"\s*<TOOLCALL>(.*?)</TOOLCALL>\s*", re.DOTALL)
TRAINING_ID = "when2call-train-"
ROLES = ("system", "developer", "user", "assistant")

_ASKS = [re.compile(p, re.IGNORECASE) for p in ASKS]
_DECLINES = re.compile(DECLINES, re.IGNORECASE)


def embedded(value: object, at: str) -> object:
    """The value of a JSON text held in a string."""
    demand(isinstance(value, str), at, "not JSON in a string")
    try:
        return strict_json.loads(value.encode())
    except strict_json.StrictError as error:
        raise AdapterError(INVALID, at, error.code) from error


def _type_name(declared: object, at: str) -> str | None:
    """The JSON Schema type of a declared one; None for any type."""
    demand(isinstance(declared, str), at, "a type is no text")
    name = declared.strip().partition(",")[0].strip()
    if name.casefold() == "any":
        return None
    known = TYPE_NAMES.get(name.casefold())
    if known is None and ARRAY_NAME.fullmatch(name):
        known = "array"
    if known is None and OBJECT_NAME.fullmatch(name):
        known = "object"
    demand(known is not None, at, f"unknown type {declared}")
    return known


def json_schema(declared: object, at: str) -> object:
    """A declared parameter schema with JSON Schema's type names, at every depth of properties and items."""
    if isinstance(declared, bool):
        return declared
    demand(isinstance(declared, dict), at, "a schema is no object")
    out = dict(declared)
    if "type" in out:
        name = _type_name(out.pop("type"), at)
        out |= {} if name is None else {"type": name}
    below = out.get("properties")
    if below is not None:
        demand(isinstance(below, dict), at, "properties are no object")
        out["properties"] = {key: json_schema(part, f"{at}/properties/{key}") for key, part in below.items()}
    if out.get("items") is not None:
        out["items"] = json_schema(out["items"], f"{at}/items")
    return out


def embedded_tools(listed: object) -> list[dict]:
    """Function tools, each a JSON text."""
    demand(isinstance(listed, list), "/tools", "tools are not an array")
    out = []
    for i, text in enumerate(listed):
        here = f"/tools/{i}"
        tool = embedded(text, here)
        demand(isinstance(tool, dict), here, "a tool is not an object")
        name, about, parameters = map(tool.get, ("name", "description", "parameters"))
        demand(filled(name) and isinstance(parameters, dict), here, "a tool has no name or no parameters")
        demand(about is None or isinstance(about, str), here, "a description is no text")
        schema = json_schema(parameters, f"{here}/parameters")
        out.append({"type": "function", "function": {"name": name, "description": about, "parameters": schema, "strict": None}})
    return out


def bare_call(call: object, call_id: str, here: str) -> dict:
    """A call of name and arguments, given ``call_id``."""
    fits = isinstance(call, dict) and filled(call.get("name")) and isinstance(call.get("arguments"), dict)
    demand(fits, here, "a call has no name or no arguments")
    return {"id": call_id, "type": "function", "function": {"name": call["name"], "arguments": call["arguments"]}}


def _row(source_id: str, turns: list[dict], tools: list[dict], action: str, paths: tuple[str, ...]) -> dict:
    return {
        "source_conversation_id": source_id,
        "conversation": canonical(turns),
        "tools": canonical(tools),
        "action": action,
        "target_message_index": len(turns) - 1,
        "observed_paths": [f"/{path}" for path in paths],
    }


def benchmark(record: dict) -> dict:
    """uuid, question, the label of the right answer, all answers, tools."""
    source_id, question, label = (text_field(record, key) for key in ("uuid", "question", "correct_answer"))
    demand(label in LABELS, "/correct_answer", f"unknown label {label}")
    answers = record.get("answers")
    demand(isinstance(answers, dict), "/answers", "answers are no object")
    at = f"/answers/{label}"
    demand(filled(answers.get(label)), at, "the right answer is no filled string")
    tools = embedded_tools(record.get("tools"))
    answer = {"content": answers[label]}
    if label == "tool_call":
        answer = {"tool_calls": [bare_call(embedded(answers[label], at), f"call_{source_id}", at)]}
    turns = [turn(role="user", content=question), turn(role="assistant", **answer)]
    return _row(source_id, turns, tools, LABELS[label], ("uuid", "question", "correct_answer", "answers", "tools"))


def _training_turns(listed: object) -> list[dict]:
    demand(isinstance(listed, list) and len(listed) > 0, "/messages", "no messages")
    turns = []
    for i, message in enumerate(listed):
        here = f"/messages/{i}"
        demand(isinstance(message, dict), here, "a message is no object")
        role, content = message.get("role"), message.get("content")
        demand(isinstance(role, str) and filled(content), here, "a message has no role or no content")
        demand(role != "tool", here, "a tool result without its call")
        demand(role in ROLES, f"{here}/role", f"unknown role {role}")
        turns.append(turn(role=role, content=content))
    return turns


def text_action(content: str, at: str) -> str:
    """Asking comes before declining."""
    if any(pattern.search(content) for pattern in _ASKS):
        return "clarification"
    demand(_DECLINES.search(content) is not None, at, "the answer neither asks nor declines")
    return "tool_unavailable"


def training(record: dict) -> dict:
    """Messages up to the answer, which is the chosen response or else the last message."""
    turns = _training_turns(record.get("messages"))
    tools = embedded_tools(record.get("tools"))
    chosen, at = record.get("chosen_response"), "/messages/-/content"
    if chosen is None:
        demand(turns[-1]["role"] == "assistant", "/messages", "no answer at the end")
        content = turns.pop()["content"]
    else:
        at = "/chosen_response/content"
        fits = isinstance(chosen, dict) and chosen.get("role") == "assistant" and isinstance(chosen.get("content"), str)
        demand(fits, "/chosen_response", "the chosen response is no assistant message")
        content = chosen["content"]
        demand(content != "", at, "the chosen response is empty")
    demand(bool(turns) and turns[-1]["role"] != "assistant", "/messages", "the answer follows no question")
    source_id = TRAINING_ID + digest(record).removeprefix("sha256:")
    marked = CALL_MARKS.fullmatch(content)
    if marked:
        calls = embedded(marked[1], at)
        demand(isinstance(calls, list) and len(calls) > 0, at, "no calls between the marks")
        made = [bare_call(call, f"call_{source_id}_{i}", f"{at}/{i}") for i, call in enumerate(calls)]
        action, answer = "tool_call", turn(role="assistant", tool_calls=made)
    else:
        action, answer = text_action(content, at), turn(role="assistant", content=content)
    paths = ("messages", "tools", *(() if chosen is None else ("chosen_response",)))
    return _row(source_id, [*turns, answer], tools, action, paths)
