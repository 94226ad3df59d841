"""Adapter of call records whose tools declare Python-like parameter types.

A type is ``base[, qualifiers]``.  The base is a name or ``Name[type, ...]``; a qualifier
that begins with "optional" or "default" ends it.  Types outside this grammar fail.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

from .adapter_base import demand, filled, native_id, text_field, two_turns
from .decisions import bare_call, embedded

# Type names of the source data.
PRIMITIVES = {"str": "string", "int": "integer", "float": "number", "bool": "boolean", "none": "null"}
BARE = {"list": {"type": "array"}, "dict": {"type": "object"}, "set": {"type": "array", "uniqueItems": True}, "tuple": {"type": "array"}}


class _Unknown(ValueError):
    pass


def _commas(text: str) -> Iterator[int]:
    """Places of the commas outside brackets, which must pair as far as this is read."""
    depth = 0
    for i, c in enumerate(text):
        depth += (c == "[") - (c == "]")
        if depth < 0:
            raise _Unknown(text)
        if c == "," and depth == 0:
            yield i
    if depth:
        raise _Unknown(text)


def unqualified(declared: str) -> tuple[str, bool]:
    """The base of a declared type, and whether it is optional."""
    for i in _commas(declared):
        rest = declared[i + 1 :].strip().lower()
        if rest.startswith(("optional", "default")):
            return declared[:i].strip(), rest.startswith("optional")
    return declared.strip(), False


def _list(parts: list[dict]) -> dict:
    return {"type": "array", "items": parts[0]}


#: Of each generic name: fewest and most parameters, and the schema made of theirs.
GENERICS: dict[str, tuple[int, float, Callable[[list[dict]], dict]]] = {
    "List": (1, 1, _list),
    "Set": (1, 1, lambda parts: _list(parts) | {"uniqueItems": True}),
    "Dict": (1, 2, lambda parts: {"type": "object"} | ({"additionalProperties": parts[1]} if parts[1:] else {})),
    "Tuple": (1, float("inf"), lambda parts: {"type": "array", "prefixItems": parts, "items": False}),
    "Union": (2, float("inf"), lambda parts: {"anyOf": parts}),
    "Optional": (1, 1, lambda parts: {"anyOf": [*parts, {"type": "null"}]}),
}


def schema_of(declared: str) -> dict:
    base, _ = unqualified(declared)
    if base.lower() in PRIMITIVES:
        return {"type": PRIMITIVES[base.lower()]}
    if base in BARE or base.capitalize() == base and base.lower() in BARE:
        return dict(BARE[base.lower()])
    name, bracket, inner = base.partition("[")
    name = name.strip()
    if name in BARE:
        name = name.capitalize()
    if not bracket or not inner.endswith("]") or name not in GENERICS:
        raise _Unknown(declared)
    inner = inner[:-1]
    parts = [inner[a + 1 : b].strip() for a, b in pairwise([-1, *_commas(inner), len(inner)])]
    fewest, most, make = GENERICS[name]
    if "" in parts or not fewest <= len(parts) <= most:
        raise _Unknown(declared)
    # only the value type of a dictionary shapes its schema
    return make([{} if name == "Dict" and i == 0 else schema_of(part) for i, part in enumerate(parts)])


def _parameter(given: object, at: str) -> tuple[dict, bool]:
    demand(isinstance(given, dict), at, "a parameter is no object")
    declared, about = given.get("type"), given.get("description")
    demand(isinstance(declared, str) and declared.strip() != "", at, "a parameter has no type")
    demand(about is None or isinstance(about, str), at, "a description is no text")
    try:
        schema = schema_of(declared)
    except _Unknown:
        demand(False, at, f"unknown type {declared}")
    extra = {"description": about, "default": given.get("default")}
    schema |= {key: value for key, value in extra.items() if value is not None}
    return schema, unqualified(declared)[1] or "default" in given


def _tools(text: object) -> list[dict]:
    listed = embedded(text, "/tools")
    demand(isinstance(listed, list), "/tools", "tools are not an array")
    out = []
    for i, tool in enumerate(listed):
        here = f"/tools/{i}"
        demand(isinstance(tool, dict), here, "a tool is not an object")
        name, about, parameters = map(tool.get, ("name", "description", "parameters"))
        demand(filled(name) and isinstance(parameters, dict), here, "a tool has no name or no parameters")
        demand(about is None or isinstance(about, str), here, "a description is no text")
        made = {}
        for key, given in parameters.items():
            demand(key != "", here, "a parameter has no name")
            made[key] = _parameter(given, f"{here}/parameters/{key}")
        needed = [key for key, (_, optional) in made.items() if not optional]
        schema = {"type": "object", "properties": {key: part for key, (part, _) in made.items()}}
        schema |= {"required": needed} if needed else {}
        out.append({"type": "function", "function": {"name": name, "description": about, "parameters": schema, "strict": None}})
    return out


def typed_calls(record: dict) -> dict:
    """id, query, and JSON texts of tools and at least one answer, each the call of a tool given."""
    source_id, query = native_id(record), text_field(record, "query")
    tools = _tools(record.get("tools"))
    answers = embedded(record.get("answers"), "/answers")
    demand(isinstance(answers, list) and len(answers) > 0, "/answers", "no answers")
    known, calls = {tool["function"]["name"] for tool in tools}, []
    for i, answer in enumerate(answers):
        here = f"/answers/{i}"
        calls.append(bare_call(answer, f"call_{source_id}_{i}", here))
        demand(answer["name"] in known, f"{here}/name", "no such tool")
    return two_turns(record, query, {"tool_calls": calls}, tools, "tool_call", ("id", "query", "tools", "answers"))
