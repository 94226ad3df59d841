"""The sink's two phases: what failed tasks, aborted jobs and two writers at once leave behind."""

import json
import os
import threading

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlstone.sources import publish, sink


def rows_of(spark, n):
    return spark.range(n).select(F.col("id"), F.to_json(F.struct("id")).alias("line"))


def test_a_failed_task_leaves_the_root_as_it_was(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    rows = rows_of(spark, 100).withColumn("line", F.when(F.col("id") != 77, F.col("line")))
    with pytest.raises(publish.PublishError, match="no line"):
        publish.publish_shards(rows, root, "x", "v", "s", ["id"], shard_rows=10)
    assert os.listdir(tmp_path / "r") == []
    manifest = publish.publish_shards(rows_of(spark, 100), root, "x", "v", "s", ["id"], shard_rows=10)
    assert len(os.listdir(tmp_path / "r")) == 11 and not publish.manifest_faults(manifest)
    assert publish.artifact_faults(spark, root, manifest).count() == 0


def test_two_writers_of_one_name(spark, tmp_path):
    root, made = f"file://{tmp_path}", []
    threads = [threading.Thread(target=lambda: made.append(publish.publish_shards(rows_of(spark, 60), root, "x", "v", "s", ["id"], shard_rows=7))) for _ in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(made) == 3 and made[0] == made[1] == made[2]
    assert len(os.listdir(tmp_path)) == 9 + 1 and publish.artifact_faults(spark, root, made[0]).count() == 0


def test_a_taken_name_must_have_the_same_bytes(tmp_path):
    store, base = sink.store_of(f"file://{tmp_path}")
    for name, text in (("a", "1"), ("b", "1"), ("c", "2"), ("t", "")):
        (tmp_path / name).write_text(text)
    (tmp_path / "t").unlink()
    assert sink.place(store, f"{base}/a", f"{base}/t") and not sink.place(store, f"{base}/b", f"{base}/t")
    with pytest.raises(sink.PublishError, match="other bytes"):
        sink.place(store, f"{base}/c", f"{base}/t")
    assert sorted(os.listdir(tmp_path)) == ["c", "t"] and (tmp_path / "t").read_text() == "1"


def writer(tmp_path, job):
    plan = {"name": "x", "schema_version": "v", "stage": "s", "inputs": [], "quarantined": 0, "contracts": {}}
    return sink.ShardWriter({"path": f"file://{tmp_path}", "plan": json.dumps(plan), "job": job})


def batches(shards, fail=False):
    yield pa.RecordBatch.from_pydict({"shard": pa.array(shards, pa.int64()), "line": [f"l{s}" for s in shards]})
    if fail:
        raise OSError("lost")


def test_attempts_aborts_and_missing_shards(tmp_path):
    one = writer(tmp_path, "j")
    with pytest.raises(OSError, match="lost"):
        one.write(batches([0, 0, 1], fail=True))
    assert os.listdir(tmp_path / "_pending-j") == []
    first = one.write(batches([0, 0, 1]))
    with pytest.raises(sink.PublishError, match="missing"):  # a task's report that never came
        one.commit([first, sink.Written([(3, "sha256:", 0, 0, "")])])
    one.commit([first, None])
    manifest = sink.receipt(f"file://{tmp_path}", "j")
    assert [a["row_count"] for a in manifest["artifacts"]] == [2, 1]
    two = writer(tmp_path, "k")
    two.write(batches([0]))
    two.abort([None])
    two.abort([None])
    assert sorted(os.listdir(tmp_path)) == sorted([*(a["relative_path"] for a in manifest["artifacts"]), f"{manifest['manifest_id']}.json"])
