"""Registered queries of publication, releases and provider failures."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.jcs import json_string, obj
from ..operators import release
from ..operators.common import shared_folder
from ..sources.publish import publish_shards
from .reference import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query("""
    WITH r AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS n, '{"doc_id":' || doc_id || ',"source":"' || source || '"}' || chr(10) AS line FROM documents),
    s AS (SELECT n // 300 AS shard, string_agg(line, '' ORDER BY n) AS body, count(*) AS row_count FROM r GROUP BY 1)
    SELECT 'documents-' || lpad(CAST(shard AS VARCHAR), 5, '0') AS logical_name, 'sha256:' || sha256(body) AS sha256,
           CAST(strlen(body) AS BIGINT) AS size, row_count FROM s""")
def published_shards(spark, sf_dir):
    """Documents' ids and sources as JSONL shards of 300 rows; the manifest's list."""
    folder = shared_folder(spark)
    line = obj(doc_id=F.col("doc_id").cast("string"), source=json_string(F.col("source")))
    rows = table(spark, sf_dir, "documents").select("doc_id", line.alias("line"))
    manifest = publish_shards(rows, f"{folder}/published-{uuid.uuid4().hex}", "documents", "document-0.1.0", "publish", ["doc_id"], shard_rows=300)
    listed = [(a["logical_name"], a["sha256"], a["size"], a["row_count"]) for a in manifest["artifacts"]]
    return spark.createDataFrame(listed, "logical_name string, sha256 string, size long, row_count long")


@query("""
    SELECT doc_id AS episode_id, CASE WHEN doc_id % 7 = 1 THEN 'no_verdict' WHEN doc_id % 7 = 2 THEN 'review_of_other_verdict'
               WHEN doc_id % 7 = 3 OR quality = 0 THEN 'no_human_acceptance' WHEN doc_id % 7 = 4 THEN 'no_gold_decision'
               WHEN toxic = 1 THEN 'not_admitted' END AS problem
    FROM labels""")
def gold_chain(spark, sf_dir):
    """Labelled documents as release members; their number breaks the chain at one place, their labels at others."""
    rows, kind = table(spark, sf_dir, "labels"), F.col("doc_id") % 7
    members = rows.select(F.col("doc_id").alias("episode_id"), F.col("doc_id").alias("verdict_id"), F.col("doc_id").alias("human_review_id"))
    verdicts = rows.where(kind != 1).select(F.col("doc_id").alias("verdict_id"), F.col("doc_id").alias("episode_id"))
    reviews = rows.select(
        F.col("doc_id").alias("review_id"),
        F.when(kind == 2, F.lit(-1)).otherwise(F.col("doc_id")).alias("verdict_id"),
        F.when(kind == 3, "model").otherwise("human").alias("authority"),
        F.when(F.col("quality") == 0, "reject").otherwise("accept_for_gold").alias("decision"),
    )
    acceptances = rows.where(kind != 4).select(
        F.col("doc_id").alias("verdict_id"),
        F.lit("human_accepted").alias("status"),
        (F.col("toxic") == 0).alias("gold_eligible"),
        F.lit("human").alias("authority"),
        F.col("doc_id").alias("human_review_id"),
    )
    return release.gold_problems(members, verdicts, reviews, acceptances).select("episode_id", "problem")


@query("""
    WITH e AS (SELECT event_id, CASE event_type WHEN 'purchase' THEN NULL WHEN 'error' THEN 'network' WHEN 'signup' THEN 'response_too_large' ELSE 'http' END AS kind,
                      400 + event_id % 130 AS status FROM events),
    c AS (SELECT event_id, kind, CASE WHEN kind = 'http' THEN CASE WHEN status IN (408, 409, 425, 429) OR status >= 500 THEN 'http_transient' ELSE 'http_permanent' END
                                      WHEN kind = 'network' THEN 'network_delivery_unknown' ELSE kind END AS failure_code FROM e)
    SELECT event_id, failure_code, CASE WHEN kind IS NULL THEN 'not_applicable' WHEN failure_code IN ('http_transient', 'network_delivery_unknown')
               THEN 'manual_retry_candidate' ELSE 'do_not_retry' END AS disposition FROM c""")
def failure_classes(spark, sf_dir):
    kinds = {"purchase": None, "error": "network", "signup": "response_too_large"}
    kind = F.lit("http")
    for event, name in kinds.items():
        kind = F.when(F.col("event_type") == event, F.lit(name)).otherwise(kind)
    events = table(spark, sf_dir, "events").select("event_id", kind.cast("string").alias("kind"), (400 + F.col("event_id") % 130).alias("status"))
    return events.select("event_id", *[c.alias(n) for n, c in release.failure(F.col("kind"), F.col("status")).items()])
