"""Source adapters: a record's own fields mapped to a conversation, with one error for a record that does not fit.

``adapt(column, "no_tool")`` turns a column of JSON objects into a struct: source_conversation_id,
conversation and tools (canonical JSON), action, target_message_index, observed_paths, and
code, pointer, message, which are null where the record fits.  Fields are read in a fixed
order and the first that does not fit names the error.  Null or unreadable JSON fails with
SCHEMA_EXPECTED_OBJECT.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.jcs import CanonicalError
from . import decisions, typed_calls
from .adapter_base import INVALID, TEXT_ACTIONS, AdapterError, call_of, demand, native_id, text_field, tools_of, two_turns

SCHEMA = (
    "source_conversation_id string, conversation string, tools string, action string, target_message_index int, "
    "observed_paths array<string>, code string, pointer string, message string"
)
FIELDS = [field.split()[0] for field in SCHEMA.split(", ")]


def xlam(record: dict) -> dict:
    """id, query, tools and at least one of tool_calls."""
    native_id(record)
    query = text_field(record, "query")
    tools = tools_of(record.get("tools"))
    calls = record.get("tool_calls")
    demand(isinstance(calls, list) and len(calls) > 0, "/tool_calls", "no calls")
    made = [call_of(call, f"/tool_calls/{i}") for i, call in enumerate(calls)]
    return two_turns(record, query, {"tool_calls": made}, tools, "tool_call", ("id", "query", "tools", "tool_calls"))


def no_tool(record: dict) -> dict:
    """id, query, response, action and perhaps tools."""
    native_id(record)
    query, response = text_field(record, "query"), text_field(record, "response")
    action = record.get("action")
    demand(action in TEXT_ACTIONS if isinstance(action, str) else False, "/action", f"action is none of {', '.join(TEXT_ACTIONS)}")
    tools = tools_of(record.get("tools", []))
    paths = ("id", "query", "response", "action", *(("tools",) if "tools" in record else ()))
    return two_turns(record, query, {"content": response}, tools, action, paths)


ADAPTERS: dict[str, Callable[[dict], dict]] = {
    "no_tool": no_tool,
    "when2call": decisions.benchmark,
    "when2call_training": decisions.training,
    "xlam": xlam,
    "xlam60k": typed_calls.typed_calls,
}


def register(name: str, adapter: Callable[[dict], dict]) -> None:
    """Make an adapter of one's own known: it takes a record and gives a row of FIELDS or raises AdapterError."""
    if name in ADAPTERS:
        raise ValueError(f"{name} is known already")
    ADAPTERS[name] = adapter


def adapt_text(text: str | None, name: str) -> dict:
    return _row_of(text, ADAPTERS[name])


def _row_of(text: str | None, adapter: Callable[[dict], dict]) -> dict:
    row = dict.fromkeys(FIELDS)
    try:
        record = json.loads(text) if text is not None else None
        demand(isinstance(record, dict), "", "not an object", "SCHEMA_EXPECTED_OBJECT")
        return row | adapter(record)
    except AdapterError as error:
        return row | error.row
    except CanonicalError as error:
        return row | {"code": INVALID, "pointer": "", "message": str(error)}
    except ValueError:
        return row | {"code": "SCHEMA_EXPECTED_OBJECT", "pointer": "", "message": "not JSON"}


def adapt(record: Column, name: str) -> Column:
    if name not in ADAPTERS:
        raise ValueError(f"unknown adapter {name!r}; known: {', '.join(ADAPTERS)}")

    adapter = ADAPTERS[name]  # sent along: the workers do not know what was registered

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_row_of(text, adapter) for text in texts], columns=FIELDS)

    return F.pandas_udf(run, SCHEMA)(record)
