import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import audit, evaluation, ledger, selection, similarity
from marlstone.plans import reference
from marlstone.sources import jsonl


def test_bronze_accounting(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_bytes(b'{"id":"x","b":1}\r\n{bad}\n\n{"id":7}')
    snapshot = jsonl.register(spark, str(tmp_path / "in"), "n", "r")
    assert snapshot["record_count"] == 4
    rows = sorted(jsonl.ingest(spark, snapshot).collect(), key=lambda r: r.byte_offset)
    assert [r.code for r in rows] == [None, "PARSE_INVALID_JSON", "PARSE_EMPTY_RECORD", None]
    assert [r.byte_offset for r in rows] == [0, 18, 24, 25] and rows[0].byte_length == 16
    assert rows[0].observed_paths == ["/id", "/b"] and rows[3].source_native_id == "7"
    total = jsonl.accounting(jsonl.ingest(spark, snapshot)).first()
    assert total.input_rows == total.valid_rows + total.quarantined_rows == 4
    (tmp_path / "in/a.jsonl").write_bytes(b"{}\n")
    with pytest.raises(Exception, match="changed"):
        jsonl.ingest(spark, snapshot).collect()


def test_input_order_never_counts(spark):
    rows = [(i, "ab"[i % 2], f"t{i % 5}") for i in range(40)]
    out = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id long, s string, t string").repartition(3)
        groups = audit.duplicate_groups(df, ["t"], "id").orderBy("t").collect()
        keyed = selection.keys(df, "t", {"s": F.concat(F.lit('"'), "s", F.lit('"'))}).withColumn("member", F.col("id"))
        queue = selection.round_robin(keyed, "member").orderBy("rank").select("rank", "id").collect()
        out.append((groups, queue))
    assert out[0] == out[1] and [r["rank"] for r in out[0][1]] == list(range(1, 41))


def test_similarity_and_components(spark):
    docs = [("a", "the quick brown fox"), ("b", "the quick brown fix"), ("c", "something else"), ("d", "THE  QUICK brown fox"), ("e", "xy"), ("f", "")]
    df = spark.createDataFrame(docs, "id string, text string")
    with pytest.raises(ValueError, match="empty"):
        similarity.candidates(df, "id", "text", 3, 0.75)
    full = df.where("id <> 'f'")
    pairs = {(r.left_id, r.right_id): r.score for r in similarity.candidates(full, "id", "text", 3, 0.75).collect()}
    assert similarity.candidates(full, "id", "text", 3, 0.0).count() == 10
    assert set(pairs) == {("a", "b"), ("a", "d"), ("b", "d")} and pairs["a", "d"] == 1.0
    edges = spark.createDataFrame(list(pairs), "left_id string, right_id string")
    roots = {r.id: r.root for r in similarity.components(df.select("id"), edges).collect()}
    assert roots == {"a": "a", "b": "a", "c": "c", "d": "a", "e": "e", "f": "f"}


def test_similarity_by_brute_force(spark):
    from marlstone.functions.text import normal_text

    rng = random.Random(6)
    base = ["".join(rng.choices("abcdeé ßﬁ", k=rng.randint(1, 60))).strip() or "x" for _ in range(12)]
    texts = []
    for i in range(150):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice("abcxyz")
        texts.append("".join(t))
    for n, threshold in ((3, 0.82), (5, 0.6), (1, 1.0)):
        sets = []
        for t in texts:
            x = normal_text(t)
            sets.append({x[k : k + n] for k in range(max(1, len(x) - n + 1))})
        want = {}
        for i, a in enumerate(sets):
            for j in range(i + 1, len(sets)):
                score = len(a & sets[j]) / len(a | sets[j])
                if score >= threshold:
                    want[i, j] = score
        rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
        got = {(r.left_id, r.right_id): r.score for r in similarity.candidates(rows, "id", "text", n, threshold).collect()}
        assert got == want and want


def test_spanning_pairs_join_what_all_pairs_join(spark):
    rng = random.Random(7)
    base = ["".join(rng.choices("abcdefg ", k=40)).strip() for _ in range(5)]
    docs = spark.createDataFrame([(i, rng.choice(base) + rng.choice(["", "x", "yz"])) for i in range(400)], "id long, text string")
    whole, few = (similarity.candidates(docs, "id", "text", spanning=spanning).localCheckpoint() for spanning in (False, True))
    assert few.exceptAll(whole).isEmpty() and whole.count() > 10_000
    assert few.count() < 3 * 400  # three pairs of blocks of 256 rows
    roots = [similarity.components(docs.select("id"), edges).collect() for edges in (whole, few)]
    assert sorted(roots[0]) == sorted(roots[1])


def test_shared_elements_with_and_without_bit_maps(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from marlstone.functions.text import packed, signature

    rng = np.random.default_rng(8)
    sets = sorted((np.unique(rng.integers(0, 900, rng.integers(1, 700)).astype(np.uint64)) for _ in range(40)), key=len)
    made = pa.table({"n_grams": [len(x) for x in sets], "packed": [packed(x) for x in sets], "bits": [signature(x) for x in sets]})
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for limit in (similarity.BITMAP_BYTES, 0):
        monkeypatch.setattr(similarity, "BITMAP_BYTES", limit)
        held = similarity._Sets(made)
        assert (held.maps is None) == (limit == 0)
        assert [held.shared(i, np.arange(40)).tolist() for i in range(40)] == want
        apart = [[len(np.setxor1d(a, b)) for b in sets] for a in sets]
        assert all(j in held.near(i, slice(0, 40), np.full(40, apart[i][j])) for i in range(40) for j in range(40))


def test_tools_of_every_episode(spark):
    from marlstone.operators import histories

    calls = "array<struct<id:string,name:string,arguments:string>>"
    rows = [(e, 0, "user", "q", None, None, None) for e in "xyz"] + [(e, 1, "assistant", None, [("c", name, "{}")], None, None) for e, name in (("x", "a"), ("y", "b"), ("z", "none"))]
    turns = spark.createDataFrame(rows, f"episode_id string, position int, role string, content string, calls {calls}, call_id string, name string")
    tools = spark.createDataFrame([(1, "b", "t2", "d2"), (0, "a", "t1", "d1")], "position int, name string, tool_id string, documentation_hash string")
    each = turns.select("episode_id").distinct().crossJoin(tools)
    for made in (histories.fingerprints, histories.history_faults):
        assert sorted(made(turns, tools).collect()) == sorted(made(turns, each).select(made(turns, tools).columns).collect())
    assert [r.episode_id for r in histories.history_faults(turns, tools).collect()] == ["z"]


def test_conflicts_read_their_input_once(spark):
    cols = "context_fp string, behavior_fp string, calls_fp string, topology string, action string, member string"
    found = spark.createDataFrame([("c", "b1", "k", "unknown", "tool_call", "1"), ("c", "b2", "k", "unknown", "tool_call", "2"), ("d", "b1", "k", "unknown", "tool_call", "3")], cols)
    made = audit.behavior_conflicts(found)
    assert [(r.context_fp, r.left_ids, r.right_ids, r.kind) for r in made.collect()] == [("c", "1", "2", "order_ambiguity_review")]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2  # the two sides, which are one shuffle


def test_pairs_of_a_block_come_in_parts():
    import pyarrow as pa

    from marlstone.functions.text import COMMON_BITS, OTHER_BITS, packed

    rows, size, bits = 1500, 70, COMMON_BITS + OTHER_BITS
    one = bytes([255] * 8 + [0] * (bits // 8 - 8))
    columns = {"id": range(rows), "n_grams": [64 + size] * rows, "packed": [packed(np.arange(1, size + 1, dtype=np.uint64))] * rows, "bits": [one] * rows}
    table = pa.table({**columns, "block": [0] * rows, "i": [0] * rows, "j": [0] * rows})
    before, most, found = pa.total_allocated_bytes(), 0, 0
    for batch in similarity._pairs(table.to_batches(400), 0.82, False):
        assert set(batch.column("score").to_pylist()) <= {1.0} and batch.num_rows < similarity.PAIRS_HELD + rows
        most, found = max(most, pa.total_allocated_bytes() - before), found + batch.num_rows
    assert found == rows * (rows - 1) // 2 and most < 24 * found / 4
    assert sum(batch.num_rows for batch in similarity._pairs(table.to_batches(400), 0.82, True)) == rows - 1


def test_pairs_where_most_grams_are_rare(spark):
    rng = random.Random(9)
    base = [[chr(rng.randrange(0x4E00, 0x9000)) for _ in range(rng.randint(40, 90))] for _ in range(120)]
    texts = []
    for _ in range(500):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = chr(rng.randrange(0x4E00, 0x9000))
        texts.append("".join(t))
    sets = [{t[k : k + 3] for k in range(len(t) - 2)} for t in texts]
    assert len(set().union(*sets)) > 8000  # more than have a bit of their own
    scores = {(i, j): len(a & sets[j]) / len(a | sets[j]) for i, a in enumerate(sets) for j in range(i + 1, len(sets))}
    want = {pair: score for pair, score in scores.items() if score >= 0.82}
    got = similarity.candidates(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text")
    assert {(r.left_id, r.right_id): r.score for r in got.collect()} == want and len(want) > 100


def test_components_run_their_edges_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "left_id long, right_id long").mapInArrow(counted, "left_id long, right_id long")
    assert {r.root for r in similarity.components(spark.range(41), edges).collect()} == {0}
    assert made.value == 40


def test_wilson(spark):
    row = spark.range(1).select(*(c.alias(n) for n, c in evaluation.wilson(F.lit(5), F.lit(10)).items())).first()
    assert (round(row.wilson_low, 6), round(row.wilson_high, 6)) == (0.236593, 0.763407)


def test_consensus_table(spark):
    rows = [("pass", False, None, "mini", True), ("pass", True, "pass", "strong", True), ("pass", True, "fail", "strong", False),
            ("fail", False, "pass", "strong", True), (None, False, "pass", "strong", True), (None, False, None, "strong", False)]
    df = spark.createDataFrame(rows, "m string, s boolean, t string, d string, ok boolean")
    got = df.withColumns(evaluation.hierarchical(F.col("m"), F.col("s"), F.col("t"))).collect()
    assert all(r.decider == r.d and (r.consensus == "accepted_for_review_package") == r.ok for r in got)


def test_escalations_and_their_results(spark):
    mini = spark.createDataFrame(
        [("a", "pass", False, "u"), ("b", "fail", False, "u"), ("c", None, False, "u"), ("d", "pass", True, "u"), ("e", "pass", False, "u"), ("f", "fail", False, "u"), ("f", "fail", False, "u")],
        "unit_id string, conclusion string, sampled boolean, unit string",
    )
    strong = spark.createDataFrame(
        [("b", "pass", "u"), ("c", None, "u"), ("d", "fail", "v"), ("d", "fail", "u"), ("e", "pass", "u"), ("x", "pass", "u")], "unit_id string, conclusion string, unit string"
    )
    got = {(r.unit_id, r.fault) for r in evaluation.escalation_faults(mini, strong).collect()}
    assert got == {
        ("d", "strong_result_twice"), ("d", "other_evaluation_unit"), ("e", "strong_result_not_escalated"), ("x", "strong_result_not_escalated"),
        ("f", "mini_result_twice"), ("f", "strong_result_missing"),
    }
    told = {r.unit_id: (r.escalation_reason, r.decider, r.consensus) for r in evaluation.decisions(mini.where("unit_id < 'd'"), strong.where("unit_id < 'd'")).collect()}
    accepted, open_ = "accepted_for_review_package", "needs_review"
    assert told == {"a": (None, "mini", accepted), "b": ("mini_non_pass", "strong", accepted), "c": ("mini_non_pass", "strong", open_)}
    with pytest.raises(Exception, match="strong_result_not_escalated at e"):
        evaluation.decisions(mini.where("unit_id in ('a', 'e')"), strong.where("unit_id = 'e'")).collect()
    assert evaluation.escalation_faults(mini.limit(0), strong.limit(0)).count() == 0


def test_ledger(spark):
    rows = [("k", 1, "h1", None), ("k", 2, "h2", "h1"), ("k", 3, "h3", "bad"), ("j", 2, "h4", None)]
    log = spark.createDataFrame(rows, "k string, seq long, h string, p string")
    got = {(r.k, r.seq): (r.sequence_ok, r.link_ok) for r in ledger.verify_chain(log, "k", "seq", "h", "p").collect()}
    assert got == {("k", 1): (True, True), ("k", 2): (True, True), ("k", 3): (True, False), ("j", 2): (False, True)}
    assert {(r.k, r.seq) for r in ledger.latest(log, "k", "seq").collect()} == {("k", 3), ("j", 2)}


def test_abbreviations_of_every_text(spark, tmp_path):
    edges = ["é", "ß", "\u0301", "·", "²", "Ⅷ", "_", "日", "🙂", "𝒜", "٣", "\u200d", "a", "1", " "]
    texts = [f"{a}API{b}B2 {b}API2{a}" for a in edges for b in edges] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = {i: ",".join(sorted(set(re.findall(r"\b[A-Z][A-Z0-9]{1,9}\b", t or "")))) for i, t in enumerate(texts)}
    got = reference.QUERIES["security_abbreviations"](spark, str(tmp_path)).collect()
    assert len(got) == len(texts) and {r.doc_id: r.abbreviations for r in got} == want
