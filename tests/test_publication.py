import json
import os

import pytest

from marlstone.operators import release
from marlstone.sources.publish import PublishError, publish_shards


def test_shards(spark, tmp_path):
    rows = spark.createDataFrame([(i % 3, json.dumps({"i": i // 2})) for i in range(20)], "k int, line string")
    made = [publish_shards(df, f"file://{tmp_path}", "x", "v", "s", ["k"], shard_rows=8, quarantined=2) for df in (rows, rows.repartition(5))]
    assert made[0] == made[1] and [a["row_count"] for a in made[0]["artifacts"]] == [8, 8, 4]
    assert made[0]["row_accounting"] == {"input": 22, "accepted": 20, "quarantined": 2}
    assert len(os.listdir(tmp_path)) == 4 and not [f for f in os.listdir(tmp_path) if "pending" in f]
    first = tmp_path / made[0]["artifacts"][0]["relative_path"]
    assert first.read_text().count("\n") == 8
    first.write_text("other")
    with pytest.raises(PublishError):
        publish_shards(rows, f"file://{tmp_path}", "x", "v", "s", ["k"], shard_rows=8)
    empty = publish_shards(rows.limit(0), f"file://{tmp_path}/e", "x", "v", "s", ["k"])
    assert [a["row_count"] for a in empty["artifacts"]] == [0]


def test_release(spark):
    members = spark.createDataFrame([("e1", "v1", "r1"), ("e2", "v2", "r1"), ("e3", None, None)], "episode_id string, verdict_id string, human_review_id string")
    verdicts = spark.createDataFrame([("v1", "e1"), ("v2", "e2"), ("v2", "e2")], "verdict_id string, episode_id string")
    reviews = spark.createDataFrame([("r1", "v1", "human", "accept_for_gold")], "review_id string, verdict_id string, authority string, decision string")
    accepted = spark.createDataFrame([("v1", "human_accepted", True, "human", "r1")], "verdict_id string, status string, gold_eligible boolean, authority string, human_review_id string")
    got = {r.episode_id: r.problem for r in release.gold_problems(members, verdicts, reviews, accepted).collect()}
    assert got == {"e1": None, "e2": "verdict_twice", "e3": "no_verdict"}
    assert release.shared_reviews(members).count() == 2
    places = spark.createDataFrame([(1, "a"), (2, "b")], "position int, episode_id string")
    other = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "position int, episode_id string")
    assert {r.position for r in release.order_problems(places, other).collect()} == {2, 3}
