"""What source adapters share: one error for a record that does not fit, and the parts of a conversation."""

from __future__ import annotations

from ..functions.jcs import canonical

MISSING, INVALID = "SOURCE_ADAPTER_MISSING_FIELD", "SOURCE_ADAPTER_INVALID_FIELD"
#: The actions of records without calls.
TEXT_ACTIONS = ("clarification", "direct_answer", "tool_unavailable")
MESSAGE_FIELDS = ("role", "content", "reasoning_content", "thinking", "tool_calls", "images", "name", "tool_call_id")


class AdapterError(ValueError):
    def __init__(self, code: str, pointer: str, message: str) -> None:
        super().__init__(message)
        self.row = {"code": code, "pointer": pointer, "message": message}


def demand(holds: bool, pointer: str, message: str, code: str = INVALID) -> None:
    if not holds:
        raise AdapterError(code, pointer, message)


def filled(value: object) -> bool:
    return isinstance(value, str) and value != ""


def text_field(record: dict, key: str) -> str:
    demand(key in record, f"/{key}", f"{key} is missing", MISSING)
    demand(filled(record[key]), f"/{key}", f"{key} is not a filled string")
    return record[key]


def native_id(record: dict) -> str:
    found = record.get("id")
    demand(isinstance(found, (str, int)) and found != "", "/id", "no conversation id", MISSING)
    return str(found)


def tools_of(listed: object, at: str = "/tools") -> list[dict]:
    """Function tools, bare or wrapped in {type, function}."""
    demand(isinstance(listed, list), at, "tools are not an array")
    out = []
    for i, tool in enumerate(listed):
        here = f"{at}/{i}"
        demand(isinstance(tool, dict), here, "a tool is not an object")
        wrapped = "function" in tool
        body = tool["function"] if wrapped else tool
        demand(isinstance(body, dict) and (not wrapped or tool.get("type", "function") == "function"), here, "not a function tool")
        own = {key: body.get(key) for key in ("name", "description", "parameters", "strict")}
        demand(filled(own["name"]) and isinstance(own["parameters"], dict), here, "a tool has no name or no parameters")
        demand(isinstance(own["description"], (str, type(None))), here, "a description is no text")
        demand(isinstance(own["strict"], (bool, type(None))), here, "strict is no boolean")
        out.append({"type": "function", "function": own})
    return out


def call_of(call: object, here: str) -> dict:
    fits = isinstance(call, dict) and filled(call.get("id")) and filled(call.get("name")) and isinstance(call.get("arguments"), dict)
    demand(fits, here, "a call has no id, no name or no arguments")
    return {"id": call["id"], "type": "function", "function": {"name": call["name"], "arguments": call["arguments"]}}


def turn(**given: object) -> dict:
    return dict.fromkeys(MESSAGE_FIELDS) | given


def two_turns(record: dict, query: str, answer: dict, tools: list[dict], action: str, paths: tuple[str, ...]) -> dict:
    return {
        "source_conversation_id": native_id(record),
        "conversation": canonical([turn(role="user", content=query), turn(role="assistant", **answer)]),
        "tools": canonical(tools),
        "action": action,
        "target_message_index": 1,
        "observed_paths": [f"/{path}" for path in paths],
    }
