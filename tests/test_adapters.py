import json

import pytest
from pyspark.sql import functions as F

from marlstone.functions import json_tree
from marlstone.sources import adapters


def test_pointers():
    doc = {"b": [1, {"x/y": None, "~": []}], "a": {}}
    assert [p for p, _ in json_tree.leaves(doc)] == ["/a", "/b/0", "/b/1/x~1y", "/b/1/~0"]
    assert [p for p, _ in json_tree.leaves(doc, empties=False)] == ["/b/0", "/b/1/x~1y"]
    assert all(json_tree.resolve(doc, p) == v for p, v in json_tree.leaves(doc))
    assert json_tree.resolve(json_tree.replace(doc, "/b/1/x~1y", 7), "/b/1/x~1y") == 7
    assert doc["b"][1]["x/y"] is None
    for wrong in ("b", "/c", "/b/2", "/b/x", "/b/0/0"):
        with pytest.raises(json_tree.PointerError):
            json_tree.resolve(doc, wrong)


CALL = {"id": "c", "name": "f", "arguments": {"x": 1}}
TOOL = {"name": "f", "parameters": {"type": "object"}}
XLAM = {"id": 1, "query": "q", "tools": [TOOL], "tool_calls": [CALL]}
TEXT = {"id": "t", "query": "q", "response": "r", "action": "clarification"}


@pytest.mark.parametrize(
    ("name", "record", "pointer"),
    [
        ("xlam", XLAM, None),
        ("xlam", XLAM | {"id": ""}, "/id"),
        ("xlam", XLAM | {"tools": None}, "/tools"),
        ("xlam", XLAM | {"tools": [TOOL, {"type": "other", "function": TOOL}]}, "/tools/1"),
        ("xlam", XLAM | {"tool_calls": []}, "/tool_calls"),
        ("xlam", XLAM | {"tool_calls": [CALL, CALL | {"arguments": "{}"}]}, "/tool_calls/1"),
        ("no_tool", TEXT, None),
        ("no_tool", TEXT | {"response": ""}, "/response"),
        ("no_tool", TEXT | {"action": "tool_call"}, "/action"),
        ("no_tool", TEXT | {"tools": [{"type": "function", "function": TOOL}]}, None),
    ],
)
def test_adapters(name, record, pointer):
    row = adapters.adapt_text(json.dumps(record), name)
    assert row["pointer"] == pointer
    assert (row["code"] is None) == (pointer is None) == (row["conversation"] is not None)
    if pointer is None:
        assert ("/tools" in row["observed_paths"]) == ("tools" in record)


def test_columns(spark):
    rows = spark.createDataFrame([(1, json.dumps(TEXT)), (2, "[]"), (3, None), (4, "{")], "k int, j string")
    got = {r.k: r.a for r in rows.select("k", adapters.adapt(F.col("j"), "no_tool").alias("a")).collect()}
    assert got[1].action == "clarification" and json.loads(got[1].conversation)[1]["content"] == "r"
    assert {got[k].code for k in (2, 3, 4)} == {"SCHEMA_EXPECTED_OBJECT"}
    assert rows.limit(0).select(adapters.adapt(F.col("j"), "xlam").alias("a")).count() == 0
    found = {r.k: r.l and [tuple(x) for x in r.l] for r in rows.select("k", json_tree.leaf_rows(F.col("j")).alias("l")).collect()}
    assert found[2] == [("/", "[]")] and found[3] is None and found[4] == [("PARSE_INVALID_JSON", None)] and ("/id", '"t"') in found[1]
