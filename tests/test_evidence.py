from marlstone.operators import evidence

ARGS = "episode string, call_id string, argument_pointer string"
GIVEN = ARGS + ", origin string, evidence_pointers array<string>, input_pointers array<string>, resolves boolean"


def test_grounding(spark):
    user, inner, target = "/conversation/1/content", "/conversation/0/content", "/conversation/2/content"
    cases = [
        ("explicit_user", [user], True, "supported"),
        ("explicit_user", [user, inner], True, "unsupported"),
        ("explicit_user", [], True, "unsupported"),
        ("system_context", [inner], True, "supported"),
        ("tool_result", [user], True, "unsupported"),
        ("prior_turn", [user, inner], True, "supported"),
        ("prior_turn", [target], True, "unsupported"),
        ("prior_turn", ["/conversation/99999999999999/content"], True, "unsupported"),
        ("prior_turn", [user], False, "unsupported"),
        ("derived", [user], True, "unresolved"),
        ("deterministic_default", ["/tools/0/x"], True, "supported"),
        ("deterministic_default", [user], True, "unsupported"),
        ("must_not_infer", [], True, "unsupported"),
        (None, None, None, "unresolved"),
    ]
    rows = [(f"e{i}", "c", "/x", o, p, p, r) for i, (o, p, r, _) in enumerate(cases)]
    keys = spark.createDataFrame([r[:3] for r in rows] + [("alone", "c", "/x")], ARGS)
    contexts = spark.createDataFrame([(r[0], ["system", "user", "assistant"], 2) for r in rows], "episode string, roles array<string>, target int")
    given = spark.createDataFrame(rows, GIVEN)
    got = {r.episode: r.status for r in evidence.grounding(keys, given, contexts).collect()}
    assert got == {f"e{i}": c[3] for i, c in enumerate(cases)} | {"alone": "unresolved"}
    assert evidence.misfits(keys, given).count() == 0
    found = evidence.misfits(keys.where("episode <> 'e0'"), given.union(given.where("episode = 'e1'"))).collect()
    assert {(r.episode, r.problem) for r in found} == {("e0", "unexpected"), ("e1", "duplicate")}
    assert evidence.outcomes(evidence.grounding(keys.limit(0), given, contexts)).count() == 0


def test_contract(spark):
    schema = "request_id int, segment_id string, {}_text string"
    asked = spark.createDataFrame([(1, "a", "⟪S1_P1⟫ x ⟪S1_P2⟫"), (1, "b", "x"), (2, "a", None)], schema.format("source"))
    given = spark.createDataFrame([(1, "a", "⟪S1_P2⟫ ⟪S1_P1⟫"), (2, "a", None), (2, "b", "x")], schema.format("target"))
    got = {(r.request_id, r.segment_id, r.problem) for r in evidence.contract_problems(asked, given).collect()}
    assert got == {(1, "a", "protected_marks"), (1, "b", "missing"), (2, "b", "extra")}
