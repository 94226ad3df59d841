import json
import random

import pytest
from pyspark.sql import functions as F

from marlstone import cli
from marlstone.functions import prompts
from marlstone.operators import release, selection
from marlstone.sources import config, jsonl, publish
from marlstone.streaming import chain


def test_byte_ranges_give_the_offsets_of_whole_files(spark, tmp_path):
    """Lines of files that are cut into many ranges, against a reader of whole files."""
    rng = random.Random(1)
    folder = tmp_path / "in"
    (folder / "deep er").mkdir(parents=True)
    want = []
    for name in ("a.jsonl", "deep er/b.jsonl", "c.jsonl"):
        lines = [rng.choice([b'{"id":"x%d"}' % i, b"", b"{bad", b"\xff", b'{"a":"\r"}', b'{"id":%d}\r' % i, b'{"t":"\xc3\xa9"}']) * rng.choice([1, 1]) for i in range(400)]
        data = b"\n".join(lines) + (b"" if name == "a.jsonl" else b"\n")
        (folder / name).write_bytes(data)
        at = 0
        for number, line in enumerate(lines if name != "a.jsonl" or lines[-1] else lines[:-1], 1):
            last = at + len(line) == len(data)  # no LF follows: its CR stays
            raw = line[:-1] if line.endswith(b"\r") and not last else line
            want.append((name, at, len(raw), number))
            at += len(line) + 1
    (folder / "empty.jsonl").write_bytes(b"")
    for range_bytes in (700, 90, 1 << 20):
        snapshot = jsonl.register(spark, str(folder), "n", "r", range_bytes)
        assert snapshot["record_count"] == len(want)
        bronze = jsonl.ingest(spark, snapshot)
        if range_bytes == 700:
            assert bronze.rdd.getNumPartitions() > 5
            rows = bronze.collect()
        else:
            assert sorted(bronze.collect()) == sorted(rows) if range_bytes > 90 else bronze.count() == len(want)
    spark_rows = jsonl._by_spark_reader(spark, snapshot, jsonl.MAX_RECORD_BYTES, "id", None).collect()
    assert sorted(map(str, spark_rows)) == sorted(map(str, rows))
    want.sort(key=lambda x: (x[0], x[1]))
    got = sorted(rows, key=lambda r: r.source_sequence)
    assert [(r.relative_file_path, r.byte_offset, r.byte_length, r.source_line) for r in got] == want
    assert [r.source_sequence for r in got] == list(range(1, len(want) + 1))
    assert jsonl.ingest(spark, snapshot, cap=3).count() == 9
    with pytest.raises(Exception, match="PARSE|SCHEMA"):
        jsonl.strict(bronze).collect()
    (folder / "c.jsonl").write_bytes(b"{}\n")
    with pytest.raises(ValueError, match="changed"):
        jsonl.verify(spark, snapshot)


def test_array_to_jsonl(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a.json").write_text('[{"b":1,"a":"é"},{}]')
    report = jsonl.array_to_jsonl(spark, str(tmp_path / "src/a.json"), f"file://{tmp_path}/out")
    written = tmp_path / "out" / report["output_relative_path"]
    assert written.read_text() == '{"a":"é","b":1}\n{}\n' and report["output_record_count"] == 2
    (tmp_path / "src/b.json").write_text('[{"a":1},2]')
    with pytest.raises(Exception, match="array of objects"):
        jsonl.array_records(spark, str(tmp_path / "src/b.json")).collect()


def test_manifests_are_read_back(spark, tmp_path):
    rows = spark.createDataFrame([(i, json.dumps({"n": i}, separators=(",", ":"))) for i in range(25)], "n int, line string")
    root = f"file://{tmp_path}/m"
    manifest = publish.publish_shards(rows, root, "x", "v", "stage", ["n"], shard_rows=10)
    assert publish.resolve(root, manifest["manifest_id"]) == manifest and not publish.manifest_faults(manifest)
    assert publish.artifact_faults(spark, root, manifest).count() == 0
    (tmp_path / "m" / manifest["artifacts"][1]["relative_path"]).write_text("{}\n")
    assert [r.fault for r in publish.artifact_faults(spark, root, manifest).collect()] == ["other_bytes"]
    broken = manifest | {"row_accounting": {"input": 1, "accepted": 1, "quarantined": 1}}
    assert set(publish.manifest_faults(broken)) == {"identity", "rows_do_not_add_up", "rows_of_artifacts_differ"}
    states = {r.stage: r.state for r in publish.stage_states(spark, {"a": root, "b": f"file://{tmp_path}/none"}).collect()}
    assert states == {"a": "complete", "b": "missing"}
    info = publish.publish_package(rows.withColumn("id", F.col("n")), f"file://{tmp_path}/p", {"format": "jsonl"}, "# card")
    assert info["splits"] == {"train": 25} and info["publish_allowed"] is False
    assert publish.schema_of(rows, "row")["properties"]["n"] == {"anyOf": [{"type": "integer"}, {"type": "null"}]}


def test_release_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"episode_id":"e1"}\n{"episode_id":"e2"}\n')
    (tmp_path / "b.jsonl").write_text('{"episode_id":"e3"}\n')
    members = [{"episode_id": f"e{i}", "verdict_id": f"v{i}", "human_review_id": f"h{i}"} for i in (1, 2, 3)]
    manifest = release.build_manifest(spark, str(tmp_path), ["a.jsonl", "b.jsonl"], members)
    path = str(tmp_path / "release.jsonl")
    release.write_manifest(manifest, path)
    assert release.read_manifest(path) == manifest
    with pytest.raises(FileExistsError):
        release.write_manifest(manifest, path)
    with pytest.raises(release.ReleaseError, match="sorted"):
        release.described_files(spark, str(tmp_path), ["b.jsonl", "a.jsonl"])
    with pytest.raises(release.ReleaseError, match="other_row 2"):
        release.build_manifest(spark, str(tmp_path), ["a.jsonl", "b.jsonl"], [members[0], {**members[1], "episode_id": "e20"}, members[2]])
    assert "review_admits_two" in release.manifest_faults(manifest | {"gold_members": [members[0], members[0] | {"episode_id": "e2"}]})
    (tmp_path / "b.jsonl").write_text('{"episode_id":"e9"}\n')
    assert release.dataset_faults(spark, str(tmp_path), manifest) == ["other_file b.jsonl"]


def test_configs():
    policy = config.field_policy('policy_version = "p"\ntool_description_action = "translate"\n[[argument_policies]]\ntool_name = "*"\nargument_pointer = "/*"\naction = "copy_exact"\n')
    assert policy.tool_description == "translate" and policy.arguments == {("*", "/*"): "copy_exact"}
    near = "ngram_size = 3\nnear_duplicate_candidate_threshold = 0.82\nselection_tiers = [30, 100, 250, 400]\n"
    assert config.similarity(near).threshold == 0.82
    for wrong in ("ngram_size = 9\nselection_tiers = [30, 100, 250, 400]", near + "automatic_similarity_drop = true", "selection_tiers = [1]"):
        with pytest.raises(config.ConfigError):
            config.similarity(wrong)
    assert not config.pipeline("max_record_bytes = 10").egress_enabled
    with pytest.raises(config.ConfigError):
        config.pipeline("max_records = 10")
    assert config.token_budgets('[providers.a]\nmodel = "m"\ndaily_token_budget = 5') == [("m", 5)]


def test_prompt_bundles():
    layers = [(name, "1", f"do {name}") for name in prompts.REQUIRED]
    made = prompts.bundle("v1", layers)
    assert made["prompt_id"].startswith("prompt_") and prompts.system_text(made).count("\n\n") == 5
    assert prompts.bundle("v1", [*layers, (prompts.OPTIONAL, "1", "x")])["prompt_id"] != made["prompt_id"]
    assert prompts.from_config({"prompt_version": "v1", "layers": {n: {"version": v, "content": c} for n, v, c in reversed(layers)}}) == made
    with pytest.raises(prompts.PromptError):
        prompts.bundle("v1", layers[::-1])
    with pytest.raises(prompts.PromptError):
        prompts.demand_validated(prompts.bundle("v1", layers, "candidate"))


def test_greedy_budget_by_brute_force(spark):
    rng = random.Random(3)
    for limit, budget in ((3, 20), (10, 60), (50, 500), (5, 0)):
        items = [(i, rng.randint(0, 15)) for i in range(200)]
        rng.shuffle(items)
        rows = spark.createDataFrame([(f"k{n:04d}", c, n) for n, c in items], "k string, c int, n long")
        want, left = [], budget
        for n, c in sorted(items):
            if c <= left and len(want) < limit:
                want.append(n)
                left -= c
        got = selection.greedy_budget(rows, "k", "c", "n", budget, limit).orderBy("rank").collect()
        assert [r.n for r in got] == want


def test_selection_errors(spark):
    rows = spark.createDataFrame([(f"s{i % 3}", f"k{i:02d}", i % 2) for i in range(30)], "s string, k string, n int")
    assert selection.automation_cohort(rows, "s", ["k"], "n", 15, 15).count() == 15
    for n, budget in ((16, 100), (15, 14)):
        with pytest.raises(selection.SelectionError):
            selection.automation_cohort(rows, "s", ["k"], "n", n, budget)
    queue = spark.createDataFrame([(i, f"e{i}", ["x"] if i % 2 else []) for i in range(1, 9)], "rank long, episode_id string, reasons array<string>")
    assert [r.reserve_rank for r in selection.frozen(queue, "episode_id", 4).orderBy("rank").collect()] == [2, 4, 6, 8]
    with pytest.raises(selection.SelectionError):
        selection.frozen(queue, "episode_id", 5)


def test_streamed_chain(spark, tmp_path):
    schema = "log string, sequence long, digest string, previous string"
    batches = [
        [("a", 1, "d1", None), ("a", 2, "d2", "d1"), ("b", 1, "x1", None)],
        [("a", 3, "d3", "wrong"), ("b", 3, "x3", "x1")],
        [("a", 4, "d4", "d3"), ("b", 2, "x2", "x1")],
    ]
    source, name = tmp_path / "events", "chained"
    source.mkdir()
    events = spark.readStream.schema(schema).parquet(str(source))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        run = chain.verify(events).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/{name}")
        run.trigger(availableNow=True).start().awaitTermination()
    got = {(r.log, r.sequence): (r.sequence_ok, r.link_ok) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {
        ("a", 1): (True, True), ("a", 2): (True, True), ("b", 1): (True, True), ("a", 3): (True, False), ("b", 3): (False, True),
        ("a", 4): (True, True), ("b", 2): (False, False),
    }


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"id":"x"}\nbad\n')
    snapshot = str(tmp_path / "snapshot.json")
    assert cli.main(["source", "register", "--root", str(tmp_path / "in"), "--namespace", "n", "--revision", "r", "--out", snapshot]) == 0
    assert cli.main(["ingest", "--snapshot", snapshot, "--out", str(tmp_path / "bronze")]) == 0
    assert '"quarantined_rows": 1' in capsys.readouterr().out
    assert cli.main(["stats", "--input", str(tmp_path / "bronze"), "--by", "status"]) == 0
    assert cli.main(["inspect", "--input", str(tmp_path / "bronze"), "--value", "x", "--keys", "source_native_id"]) == 0
    assert cli.main(["inspect", "--input", str(tmp_path / "bronze"), "--value", "none", "--keys", "source_native_id"]) == 1
    assert cli.main(["diagnostics"]) == 0 and capsys.readouterr().out.count("\n") >= 21
    (tmp_path / "in/a.jsonl").write_text("{}\n")
    assert cli.main(["source", "validate", "--snapshot", snapshot]) == 1
    assert cli.main(["source", "validate", "--snapshot", str(tmp_path / "none")]) == 2 and cli.main(["no such"]) == 2
    assert cli.main(["status", f"a={tmp_path}/none"]) == 0


def test_event_log(spark, tmp_path):
    from datetime import UTC, datetime

    from marlstone.operators import ledger, review
    from marlstone.sources import log

    root, moment = str(tmp_path / "log"), datetime(2024, 1, 2, 3, 4, 5, 60, tzinfo=UTC)
    decision = {"conflict_id": "c", "left_episode_id": "a", "right_episode_id": "b", "decision": "defer", "reviewer_authority": "human", "rationale": "r"}
    first = log.adjudicate(root, "run", decision, review.DECISIONS)
    with pytest.raises(log.LogError, match="supersedes"):
        log.adjudicate(root, "run", decision, review.DECISIONS)
    with pytest.raises(log.LogError, match="person"):
        log.adjudicate(root, "run", decision | {"supersedes_event_id": first["event_id"], "reviewer_authority": "model"}, review.DECISIONS)
    log.adjudicate(root, "run", decision | {"supersedes_event_id": first["event_id"]}, review.DECISIONS)
    assert log.append(root, "run", "s", "t", {}, moment=moment)["timestamp_utc"] == "2024-01-02T03:04:05.000060Z"
    rows = log.table(spark, root).withColumn("log", F.lit("l"))
    checked = ledger.verify_chain(rows, "log", "sequence", "event_hash", "previous_event_hash").collect()
    assert len(checked) == 3 and all(r.sequence_ok and r.link_ok for r in checked)
    path = next((tmp_path / "log").glob("000000000002-*.jsonl"))
    path.write_text(path.read_text().replace("defer", "source_error"))
    with pytest.raises(log.LogError, match="not the event"):
        log.read(root)


def test_extension_points(spark):
    from marlstone.operators import provider, render
    from marlstone.sources import adapter_base, adapters

    def own(record):
        adapter_base.demand("q" in record, "/q", "no question")
        return adapter_base.two_turns({"id": record["n"]}, record["q"], {"content": "a"}, [], "direct_answer", ("q",))

    adapters.register("own", own)
    try:
        with pytest.raises(ValueError, match="already"):
            adapters.register("own", own)
        rows = spark.createDataFrame([('{"n":1,"q":"x"}',), ('{"n":2}',)], "j string").select(adapters.adapt(F.col("j"), "own").alias("a")).select("a.*").collect()
        assert [(r.source_conversation_id, r.pointer) for r in rows] == [("1", None), (None, "/q")]
    finally:
        del adapters.ADAPTERS["own"]

    def translate(text):
        if text == "bad":
            raise TimeoutError("secret")
        return text.upper()

    asked = spark.createDataFrame([(1, "ok"), (2, "bad")], "n int, request string")
    assert [tuple(r) for r in provider.answered(asked, translate).orderBy("n").collect()] == [(1, "ok", "OK", None), (2, "bad", None, "TimeoutError")]

    def renderer(episode):
        return {"text": f"[{episode['t']}]", "structure": "s", "truncated": False, "ranges": [(1, 1 + len(episode["t"]))]}

    episodes = spark.createDataFrame([('{"t":"abc"}', "abc", "s"), ('{"t":"x"}', "y", "s")], "episode string, payload string, expected_structure string")
    made = render.rendered(episodes, renderer, lambda text: [(ord(c), i, i + 1) for i, c in enumerate(text)])
    found = {r.episode: (r.fault, r.labels) for r in render.supervised(made).collect()}
    assert found == {'{"t":"abc"}': (None, [-100, 97, 98, 99, -100]), '{"t":"x"}': ("payload_differs", None)}


def test_documents_are_written_in_files_of_each_part(spark, tmp_path):
    from marlstone.plans import provider

    rows = spark.range(400).selectExpr("id AS doc_id", "'some text' AS text", "9 AS n_chars", "if(id % 2 = 0, 'de', 'en') AS lang")
    rows.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        folder = provider._written(spark, str(tmp_path), "bronze")
        files = {r[0] for r in spark.read.text(folder).select("_metadata.file_path").distinct().collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(files) >= 8  # no shuffle that brings a language to one task
