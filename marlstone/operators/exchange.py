"""Requests to and answers from model services, in two styles, as columns of JSON; nothing is sent.

``chat``: one choice that stopped by itself, whose message has text.  ``responses``: output
messages that hold exactly one output text.  An answer that is not so has a fault and no text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.jcs import arr, json_string, obj
from .review import verdict_faults

_CHAT = "choices array<struct<finish_reason:string,message:struct<content:string>>>"
_RESPONSES = "output array<struct<type:string,content:array<struct<type:string,text:string>>>>"
_JUDGEMENT = (
    "conclusion string, findings array<struct<category:string,severity:string,source_excerpt:string,target_excerpt:string,rationale:string>>, "
    "unresolved_reasons array<string>"
)


def _message(role: str, content: Column) -> Column:
    return obj(role=F.lit(f'"{role}"'), content=content)


def chat_request(model: Column, system: Column, user: Column, max_tokens: int, thinking: bool = False) -> Column:
    """Canonical JSON of a request for one JSON object."""
    if not 1 <= max_tokens <= 4096:
        raise ValueError("max_tokens must be 1 to 4096")
    return obj(
        model=json_string(model),
        messages=arr(F.array(_message("system", json_string(system)), _message("user", json_string(user)))),
        response_format=F.lit('{"type":"json_object"}'),
        stream=F.lit("false"),
        max_tokens=F.lit(str(max_tokens)),
        thinking=F.lit('{"type":"enabled"}' if thinking else '{"type":"disabled"}'),
    )


def responses_request(model: Column, system: Column, user: Column, name: str, schema: str, metadata: dict[str, Column]) -> Column:
    """Canonical JSON of a request for text that fits ``schema`` (canonical JSON); nothing is to be stored."""
    part = lambda text: arr(F.array(obj(type=F.lit('"input_text"'), text=json_string(text))))
    form = obj(type=F.lit('"json_schema"'), name=F.lit(f'"{name}"'), strict=F.lit("true"), schema=F.lit(schema))
    return obj(
        model=json_string(model),
        input=arr(F.array(_message("system", part(system)), _message("user", part(user)))),
        text=obj(format=form),
        metadata=obj(**{key: json_string(value) for key, value in metadata.items()}),
        store=F.lit("false"),
    )


def _answer(text: Column, fault: Column) -> Column:
    return F.struct(F.when(fault.isNull(), text).alias("text"), fault.alias("fault"))


def chat_text(body: Column) -> Column:
    """Struct text, fault of an answer in the chat style."""
    found = F.from_json(body, _CHAT)
    one = F.get(found["choices"], F.lit(0))
    text = one["message"]["content"]
    fault = (
        F.when(found.isNull() | found["choices"].isNull(), "no_envelope")
        .when(F.size(found["choices"]) != 1, "not_one_choice")
        .when(~F.coalesce(one["finish_reason"] == "stop", F.lit(False)), "not_stopped")
        .when(F.coalesce(text, F.lit("")) == "", "no_text")
    )
    return _answer(text, fault)


def responses_text(body: Column) -> Column:
    """Struct text, fault of an answer in the responses style."""
    found = F.from_json(body, _RESPONSES)
    messages = F.filter(F.coalesce(found["output"], F.array().cast("array<struct<type:string,content:array<struct<type:string,text:string>>>>")), lambda m: m["type"] == "message")
    parts = F.flatten(F.transform(messages, lambda m: F.coalesce(m["content"], F.array().cast("array<struct<type:string,text:string>>"))))
    texts = F.transform(F.filter(parts, lambda p: p["type"] == "output_text"), lambda p: p["text"])
    fault = (
        F.when(found.isNull() | found["output"].isNull(), "no_envelope")
        .when(F.size(texts) != 1, "not_one_text")
        .when(F.get(texts, F.lit(0)).isNull(), "no_text")
    )
    return _answer(F.get(texts, F.lit(0)), fault)


def judgement(answer: Column, source: Column, target: Column) -> Column:
    """Struct conclusion, findings, reasons, faults of a judge's JSON answer about one pair of texts.

    A finding must quote both texts: an excerpt that is not in its text is a fault of the whole answer.
    """
    found = F.from_json(answer, _JUDGEMENT)
    findings, reasons = found["findings"], found["unresolved_reasons"]
    whole = F.coalesce(found["conclusion"].isNotNull() & findings.isNotNull() & reasons.isNotNull(), F.lit(False))
    ids = F.transform(findings, lambda f: F.concat_ws("/", f["category"], f["severity"], f["source_excerpt"], f["target_excerpt"]))
    quoted = lambda text, part: F.coalesce((part != "") & F.contains(text, part), F.lit(False))
    grounded = F.forall(findings, lambda f: quoted(source, f["source_excerpt"]) & quoted(target, f["target_excerpt"]))
    more = F.array_compact(F.array(F.when(~grounded, "excerpt_not_in_text")))
    rules = verdict_faults(found["conclusion"], F.array_sort(F.array_distinct(ids)), F.array_sort(F.array_distinct(reasons)))
    faults = F.when(whole, F.concat(rules, more)).otherwise(F.array(F.lit("no_judgement")))
    return F.struct(found["conclusion"].alias("conclusion"), findings.alias("findings"), reasons.alias("reasons"), faults.alias("faults"))
