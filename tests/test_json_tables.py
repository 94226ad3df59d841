"""The table functions against the column functions, from SQL text."""

import collections
import json

import pytest
from pyspark.sql import functions as F

from marlstone.functions import json_tables, json_tree
from marlstone.operators import tools

TEXTS = [None, "", "{", "1", "{}", "[]", '{"a/b":[1,{"~":null}],"e":{},"é":"x"}', '[[[["deep"]]]]', '{"a":1}', '{"a":1}', "[" * 5000]


def episode(i, text="hello", role="user"):
    return json.dumps({"schema_version": "x", "episode_id": f"ep{i}", "conversation": [{"role": role, "content": text}, {"role": "assistant", "content": "an answer"}], "tools": []})


@pytest.fixture(scope="module")
def sql(spark):
    json_tables.register(spark)
    return spark.sql


def test_leaves_from_sql(spark, sql):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "pointer int, t string")
    for empties in ("true", "false"):
        got = sql(f"SELECT e.pointer AS id, l.* FROM {{e}} e, LATERAL json_leaves(t, {empties}) l", e=rows).collect()
        want = rows.select("pointer", F.explode(json_tree.leaf_rows(F.col("t"), empties == "true")).alias("x")).select("pointer", "x.*").collect()
        assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, want))
    assert sql("SELECT * FROM json_leaves(CAST(NULL AS STRING))").count() == 0
    with pytest.raises(Exception, match="takes a text"):
        sql("SELECT * FROM json_leaves(1)").collect()


@pytest.mark.parametrize("clause", ["", " PARTITION BY (k)", " PARTITION BY (k) ORDER BY (i)"])
def test_segments_from_sql(spark, sql, clause):
    texts = [episode(i, f"text {i % 3}") for i in range(40)] + [None, "{", episode(99, "x", "stranger"), episode(5, "text 2")]
    rows = spark.createDataFrame([(i, i % 4, t, None) for i, t in enumerate(texts)], "i int, k int, episode string, note string")
    got = sql(f"""SELECT * FROM episode_segments(TABLE(SELECT * FROM {{rows}}){clause}, 'episode', '{{{{"version": "p1"}}}}')""", rows=rows)
    assert got.columns == ["i", "k", "note", "position", "json_pointer", "source_text", "source_sha256", "segment_id", "code"]
    found = rows.select("i", tools.leaf_segments(F.col("episode"), tools.FieldPolicy("p1")).alias("s")).select("i", "s.*")
    want = {(r.i, s.json_pointer, s.source_text, s.segment_id) for r in found.where("code is null").collect() for s in r.segments}
    assert {(r.i, r.json_pointer, r.source_text, r.segment_id) for r in got.where("code is null").collect()} == want and len(want) == 82
    assert [(r.i, r.code, r.position) for r in got.where("code is not null").orderBy("i").collect()][0] == (41, "PARSE_INVALID_JSON", None)
    assert {r.i for r in got.where("code is not null").collect()} == {41, 42}
    assert [r.position for r in got.where("i = 0").orderBy("position").collect()] == [0, 1]
    assert sql("""SELECT * FROM episode_segments(TABLE(SELECT * FROM {rows}), 'episode', '{{"version": "p1"}}')""", rows=rows.limit(0)).count() == 0


def test_what_analysis_refuses(spark, sql):
    rows = spark.createDataFrame([(1, "{}")], "code int, episode string")
    for column, policy, said in (("other", "p1", "no column other"), ("episode", "p1", "a column code already")):
        with pytest.raises(Exception, match=said):
            sql(f"""SELECT * FROM episode_segments(TABLE(SELECT * FROM {{rows}}), '{column}', '{{{{"version": "{policy}"}}}}')""", rows=rows).collect()


def test_policies_from_json():
    made = json_tables.policy_of('{"version": "p", "arguments": {"f /n": "translate", "* /*": "copy_exact"}}')
    assert made == tools.FieldPolicy("p", arguments={("f", "/n"): tools.TRANSLATE, ("*", "/*"): tools.COPY})
