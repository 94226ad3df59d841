import json

import pytest
from pyspark.sql import functions as F

from marlstone.functions import json_schema as js
from marlstone.functions.jcs import canonical
from marlstone.operators import tools
from marlstone.sources import adapters, typed_calls

TOOL = {"name": "f", "description": "d", "parameters": {"type": "dict", "properties": {"x": {"type": "List[int], optional"}, "y": {"type": "any"}}}}


def test_structural_form():
    a = {"type": "object", "title": "t", "required": ["b", "a"], "anyOf": [{"type": "string"}, {"const": 1}]}
    b = {"anyOf": [{"const": 1}, {"description": "x", "type": "string"}], "required": ["a", "b"], "type": "object"}
    assert js.structural(a) == js.structural(b)
    assert js.structural({"prefixItems": [True, {}]}) != js.structural({"prefixItems": [{}, True]})
    for schema, code, at in [
        ({"properties": {"a/b": {"what": 1}}}, "SCHEMA_UNSUPPORTED_KEYWORD", "/properties/a~1b/what"),
        ({"items": {"$ref": "http://x"}}, "SCHEMA_UNSUPPORTED_KEYWORD", "/items/$ref"),
        ({"enum": [1, 2, 1]}, "SCHEMA_DUPLICATE_SET_VALUE", "/enum"),
        ({"dependentRequired": {"a": [1]}}, "TOOL_DEFINITION_INVALID", "/dependentRequired/a"),
        ({"not": []}, "TOOL_DEFINITION_INVALID", "/not"),
        (None, "TOOL_DEFINITION_INVALID", "/"),
    ]:
        with pytest.raises(js.SchemaError) as error:
            js.structural(schema)
        assert (error.value.code, error.value.pointer) == (code, at)
    assert js.well_formed({"type": ["null", "string"], "minLength": 1}) and not js.well_formed({"properties": {"a": {"type": "text"}}})


@pytest.mark.parametrize(
    ("schema", "good", "bad"),
    [
        ({"type": "integer"}, [1, 2.0], [True, 1.5, "1"]),
        ({"enum": [1, None]}, [1.0, None], [True, 0]),
        ({"type": ["string", "null"], "maxLength": 2, "pattern": "^a"}, ["ab", None], ["abc", "b"]),
        ({"minimum": 1, "exclusiveMaximum": 3, "multipleOf": 0.5}, [1, 2.5, "x"], [0, 3, 1.2]),
        ({"required": ["a"], "additionalProperties": False, "properties": {"a": {}}}, [{"a": 1}, 3], [{}, {"a": 1, "b": 1}]),
        ({"prefixItems": [{"type": "string"}], "items": False}, [["a"], []], [[1], ["a", 2]]),
        ({"contains": {"const": 1}, "uniqueItems": True}, [[1, True]], [[2], [1, 1.0]]),
        ({"anyOf": [{"type": "string"}, {"type": "null"}]}, ["", None], [1]),
        ({"oneOf": [{"minimum": 1}, {"maximum": 3}]}, [0, 9], [2]),
        ({"if": {"type": "string"}, "then": {"minLength": 1}, "else": {"not": {"const": 0}}}, ["a", 1], ["", 0]),
        ({"$defs": {"n": {"type": "object", "properties": {"n": {"$ref": "#/$defs/n"}}}}, "$ref": "#/$defs/n"}, [{"n": {"n": {}}}], [{"n": {"n": 1}}]),
        (False, [], [None]),
    ],
)
def test_validation(schema, good, bad):
    assert [js.problems(schema, v) for v in good] == [[]] * len(good)
    assert all(js.problems(schema, v) for v in bad)


def test_declared_types():
    for text, want in [
        ("str", {"type": "string"}),
        ("List[Union[int, str]], optional, default 3", {"type": "array", "items": {"anyOf": [{"type": "integer"}, {"type": "string"}]}}),
        ("Dict[str, float]", {"type": "object", "additionalProperties": {"type": "number"}}),
        ("Tuple[int, bool]", {"type": "array", "prefixItems": [{"type": "integer"}, {"type": "boolean"}], "items": False}),
        ("Optional[set]", {"anyOf": [{"type": "array", "uniqueItems": True}, {"type": "null"}]}),
    ]:
        assert typed_calls.schema_of(text) == want
    for text in ("thing", "List[]", "List[int", "List[int]]", "Union[int]", "List[int, str]", "List[int][str]", ""):
        with pytest.raises(ValueError):
            typed_calls.schema_of(text)
    assert [typed_calls.unqualified(t)[1] for t in ("int, optional", "int, default 1", "int")] == [True, False, False]


def test_more_adapters():
    bench = {"uuid": "u", "question": "q", "correct_answer": "tool_call", "answers": {"tool_call": '{"name":"f","arguments":{}}'}, "tools": [json.dumps(TOOL)]}
    row = adapters.adapt_text(json.dumps(bench), "when2call")
    made = json.loads(row["tools"])[0]["function"]["parameters"]
    assert row["code"] is None and json.loads(row["conversation"])[1]["tool_calls"][0]["id"] == "call_u" and made["type"] == "object"
    assert made["properties"] == {"x": {"type": "array"}, "y": {}}
    for change, at in [({"uuid": ""}, "/uuid"), ({"correct_answer": "no"}, "/correct_answer"), ({"answers": {"tool_call": "{"}}, "/answers/tool_call"), ({"tools": ["[]"]}, "/tools/0")]:
        assert adapters.adapt_text(json.dumps(bench | change), "when2call")["pointer"] == at
    asked = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "Sorry, could you provide it?"}], "tools": []}
    row = adapters.adapt_text(json.dumps(asked), "when2call_training")
    assert (row["action"], row["target_message_index"]) == ("clarification", 1) and row["source_conversation_id"].startswith("when2call-train-")
    called = asked | {"messages": asked["messages"][:1], "chosen_response": {"role": "assistant", "content": ' <TOOLCALL>[{"name":"f","arguments":{}}]</TOOLCALL>\n'}}
    row = adapters.adapt_text(json.dumps(called), "when2call_training")
    assert row["action"] == "tool_call" and row["observed_paths"][-1] == "/chosen_response"
    for change, at in [({"messages": []}, "/messages"), ({"chosen_response": {"role": "assistant", "content": "Fine."}}, "/messages"), ({"messages": asked["messages"][:1]}, "/messages")]:
        assert adapters.adapt_text(json.dumps(asked | change), "when2call_training")["pointer"] == at
    typed = {"id": 7, "query": "q", "tools": json.dumps([{"name": "f", "parameters": {"a": {"type": "int", "default": 1}, "b": {"type": "str"}}}]), "answers": '[{"name":"f","arguments":{}}]'}
    row = adapters.adapt_text(json.dumps(typed), "xlam60k")
    assert json.loads(row["tools"])[0]["function"]["parameters"]["required"] == ["b"] and row["source_conversation_id"] == "7"
    for change, at in [({"answers": "[]"}, "/answers"), ({"answers": '[{"name":"g","arguments":{}}]'}, "/answers/0/name"), ({"tools": '[{"name":"f","parameters":{"a":{"type":"odd"}}}]'}, "/tools/0/parameters/a")]:
        assert adapters.adapt_text(json.dumps(typed | change), "xlam60k")["pointer"] == at


def _episode():
    call = {"id": "c", "type": "function", "function": {"name": "f", "arguments": {"x": "wide words", "k": "id"}}}
    tool = {"type": "function", "function": {"name": "f", "parameters": {"type": "object", "properties": {"x": {"type": "string"}, "k": {"type": "string", "format": "uuid"}}}}}
    turns = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": None, "tool_calls": [call]}]
    adapted = {"source_conversation_id": "s", "conversation": turns, "tools": [tool], "action": "tool_call", "target_message_index": 1, "observed_paths": []}
    return tools.episode_of(adapted, {"source_occurrence_id": "occ_1"}, "evt_1")


def test_field_policy_and_merge(spark):
    episode = _episode()
    policy = tools.FieldPolicy("p", arguments={("f", "/x"): "translate", ("*", "/*"): "copy_exact"})
    found = tools.segments_of(episode, policy)
    assert [s["json_pointer"] for s in found] == ["/conversation/0/content", "/conversation/1/tool_calls/0/function/arguments/x"]
    same = tools.merged(episode, policy, {s["segment_id"]: s["source_text"] for s in found})
    assert same == episode
    new = tools.merged(episode, policy, {s["segment_id"]: "neu" for s in found})
    assert new["parent_variant_id"] == episode["variant_id"] != new["variant_id"] and new["episode_id"] == episode["episode_id"]
    for arguments, code in [({}, "FIELD_POLICY_UNCOVERED"), ({("f", "/k"): "translate", ("*", "/*"): "copy_exact"}, "FIELD_POLICY_UNSAFE"), ({("f", "/x"): "manual_policy_required", ("*", "/*"): "copy_exact"}, "FIELD_POLICY_UNRESOLVED")]:
        with pytest.raises(tools.EpisodeError) as error:
            tools.segments_of(episode, tools.FieldPolicy("p", arguments=arguments))
        assert error.value.code == code
    with pytest.raises(ValueError):
        tools.FieldPolicy("p", arguments={("*", "/*"): "translate"})
    frame = spark.createDataFrame([(episode["episode_id"], canonical(episode)), ("none", None)], "episode_id string, episode string")
    targets = spark.createDataFrame([(episode["episode_id"], s["segment_id"], "neu") for s in found], "episode_id string, segment_id string, target_text string")
    rows = {r.episode_id: r for r in tools.merge_segments(frame, targets, policy).collect()}
    assert json.loads(rows[episode["episode_id"]].merged) == new and rows["none"].code == "SCHEMA_EXPECTED_OBJECT"
    twice = tools.merge_segments(frame, targets.union(targets), policy).where("code = 'SEGMENT_COVERAGE'")
    assert twice.count() == 1


def test_registry_and_memory(spark):
    texts = [(canonical({"type": "function", "function": {"name": "f", "description": d, "parameters": {"type": "object"}}}),) for d in "aab"]
    rows = tools.registry(spark.createDataFrame([*texts, (None,), ("[]",)], "tool string")).collect()
    assert len({r.tool_id for r in rows if r.code is None}) == 1 and sum(r.code is None for r in rows) == 2 and len(rows) == 4
    key = dict.fromkeys(tools.MEMORY_KEY, "v") | {"tool_scope": ["t"]}
    schema = ", ".join(f"{k} {'array<string>' if k == 'tool_scope' else 'string'}" for k in tools.MEMORY_KEY)
    entries = spark.createDataFrame([(*key.values(), i, t, s) for i, t, s in [("m2", "a", "active"), ("m1", "a", "active"), ("m0", "b", "revoked")]], schema + ", memory_entry_id string, target_text string, state string")
    requests = spark.createDataFrame([tuple(key.values()), tuple((key | {"decision_action": None}).values())], schema)
    got = {r.decision_action: r for r in tools.memory_lookup(requests, entries).collect()}
    assert (got["v"].memory_entry_id, got["v"].conflict) == ("m1", False) and got[None].target_text is None
    clash = tools.memory_lookup(requests, entries.withColumn("state", F.lit("active"))).where("conflict").collect()
    assert len(clash) == 1 and clash[0].target_text is None


UNEVALUATED = [
    # schema, values that fit, values that do not
    ({"properties": {"a": {}}, "unevaluatedProperties": False}, [{}, {"a": 1}, 3], [{"b": 1}]),
    ({"allOf": [{"properties": {"a": {}}}], "unevaluatedProperties": False}, [{"a": 1}], [{"a": 1, "b": 1}]),
    ({"allOf": [{"additionalProperties": True}], "unevaluatedProperties": False}, [{"b": 1}], []),
    ({"anyOf": [{"properties": {"a": {"const": 1}}, "required": ["a"]}, {"properties": {"b": {"const": 1}}, "required": ["b"]}], "unevaluatedProperties": False},
     [{"a": 1}, {"b": 1}, {"a": 1, "b": 1}], [{"a": 1, "b": 2}, {"a": 2, "b": 1}]),
    ({"oneOf": [{"properties": {"a": {"const": 1}}, "required": ["a"]}, {"properties": {"b": {"const": 1}}, "required": ["b"]}], "unevaluatedProperties": False},
     [{"a": 1}, {"b": 1}], [{"a": 1, "b": 2}, {"a": 1, "c": 1}]),
    ({"not": {"not": {"properties": {"a": {}}, "required": ["a"]}}, "unevaluatedProperties": False}, [], [{"a": 1}]),
    ({"if": {"properties": {"k": {"const": 1}}, "required": ["k"]}, "then": {"properties": {"a": {}}}, "else": {"properties": {"b": {}}}, "unevaluatedProperties": False},
     [{"k": 1, "a": 1}, {"b": 1}], [{"k": 1, "b": 1}, {"k": 2, "b": 1}, {"a": 1}]),
    ({"if": {"patternProperties": {"^x": {"type": "string"}}, "required": ["xa"]}, "unevaluatedProperties": False}, [{"xa": "s"}, {}], [{"xb": "s"}, {"xa": "s", "y": 1}]),
    ({"dependentSchemas": {"a": {"properties": {"b": {}}}}, "properties": {"a": {}}, "unevaluatedProperties": False}, [{"a": 1, "b": 1}], [{"b": 1}]),
    ({"$ref": "#/$defs/d", "$defs": {"d": {"properties": {"a": {}}}}, "unevaluatedProperties": {"type": "string"}}, [{"a": 1, "b": "x"}], [{"a": 1, "b": 1}]),
    ({"allOf": [{"properties": {"a": {}}, "unevaluatedProperties": True}], "unevaluatedProperties": False}, [{"a": 1, "b": 1}], []),
    ({"allOf": [{"properties": {"a": {}}}, {"unevaluatedProperties": False}]}, [{}], [{"a": 1}]),
    ({"properties": {"deep": {"properties": {"a": {}}}}, "unevaluatedProperties": False}, [{"deep": {"b": 1}}], [{"a": 1}]),
    ({"$ref": "#/$defs/t", "$defs": {"t": {"properties": {"next": {"$ref": "#/$defs/t"}}, "required": []}}, "unevaluatedProperties": False},
     [{"next": {"next": {}}}, {"next": {"x": 1}}], [{"x": 1}]),
    ({"$ref": "#", "unevaluatedProperties": False}, [{}], [{"a": 1}]),
    ({"prefixItems": [{"type": "string"}], "unevaluatedItems": False}, [[], ["x"], {"a": 1}], [["x", 1]]),
    ({"prefixItems": [{}], "items": {"type": "integer"}, "unevaluatedItems": False}, [["x", 1, 2]], [["x", "y"]]),
    ({"allOf": [{"prefixItems": [{}, {"type": "integer"}]}], "prefixItems": [{}], "unevaluatedItems": False}, [["x", 1]], [["x", 1, 2]]),
    ({"contains": {"type": "string"}, "unevaluatedItems": {"type": "integer"}}, [["x", 1, "y"]], [["x", 1.5], [1]]),
    ({"anyOf": [{"items": {"type": "string"}}, {"prefixItems": [True]}], "unevaluatedItems": False}, [["x", "y"], [1]], [[1, "y"]]),
    ({"if": {"prefixItems": [{"const": 1}]}, "then": {"prefixItems": [True, True]}, "unevaluatedItems": False}, [[1, 2], []], [[1, 2, 3], [2, 2]]),
]


def test_unevaluated_members_and_items():
    for schema, good, bad in UNEVALUATED:
        assert js.well_formed(schema)
        assert [js.problems(schema, v) for v in good] == [[]] * len(good), schema
        assert all(js.problems(schema, v) for v in bad), schema


def test_unevaluated_arguments_equal_their_sql(spark):
    import duckdb

    from marlstone.plans import tools as plans

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    for name in ("unevaluated_arguments", "canonical_call_episodes"):
        got = sorted((r.doc_id, r.code or "") for r in plans.QUERIES[name](spark, "/root/testdata/sf0.001").collect())
        want = sorted((r[0], r[1] or "") for r in con.execute(f"SELECT doc_id, code FROM ({plans.ORACLES[name]})").fetchall())
        assert got == want and len({c for _, c in got}) > 1


def test_canonical_episodes_run_in_small_batches(spark, tmp_path):
    from marlstone.plans import tools as plans

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    spark.range(20).selectExpr("id AS doc_id", "9 AS n_chars", "'de' AS lang").write.parquet(str(tmp_path / "documents.parquet"))
    assert plans.QUERIES["unevaluated_arguments"](spark, str(tmp_path)).count() == 20
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_canonical_texts_of_every_kind_of_character():
    from marlstone.functions import jcs

    for text in [chr(i) for i in range(0x250)] + [" ", "퟿", "", "\U0001f600", 'a"b\\c/']:
        assert jcs.canonical(text) == f'"{text.translate(jcs._ESCAPES)}"'
    for text in ("\ud800", "a\udfff"):
        with pytest.raises(jcs.CanonicalError):
            jcs.canonical(text)
    assert jcs.canonical({"": 1, "\U0001f600": 2, "a": 3}) == '{"a":3,"\U0001f600":2,"":1}'
