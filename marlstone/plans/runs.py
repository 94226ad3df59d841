"""Registered queries of runs that can be taken up again, on recorded answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import runs
from .reference import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def _body(route: str, model: str, status: str, code: str, result: str) -> str:
    """SQL for a route's id."""
    text = lambda x: f"coalesce('\"' || {x} || '\"', 'null')"
    return (
        f"'autoroute_' || sha256('{{\"episode_id\":\"' || k || '\",\"failure_code\":' || {text(code)} || ',\"model\":\"{model}\",\"route\":\"{route}\",\"schema_version\":\"autonomous-route-0.1.0\","
        f"\"status\":\"' || {status} || '\",\"translation_result\":' || {text(result)} || '}}')"
    )


@query(f"""
    WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders),
    a AS (SELECT k, CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN 'failed' WHEN k % 5 = 0 THEN 'research_needed' WHEN k % 3 = 0 THEN 'failed' ELSE 'translated' END AS s1,
                 CASE WHEN k % 7 = 0 THEN 'provider_response_invalid' WHEN k % 11 = 0 THEN 'malformed_response' WHEN k % 5 > 0 AND k % 3 = 0 THEN 'http_permanent' END AS f1 FROM o),
    b AS (SELECT *, CASE WHEN s1 = 'translated' THEN 'fast ' || k END AS r1, coalesce(f1, s1) IN ('provider_response_invalid', 'malformed_response', 'research_needed') AS again FROM a),
    c AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'translated' ELSE 'failed' END AS s2, CASE WHEN k % 2 = 1 THEN 'http_transient' END AS f2, CASE WHEN k % 2 = 0 THEN 'strong ' || k END AS r2 FROM b)
    SELECT CAST(k AS VARCHAR) AS job_id, CASE WHEN s1 = 'translated' OR (again AND s2 = 'translated') THEN 'translated' ELSE 'needs_review' END AS status,
           CASE WHEN again THEN 2 ELSE 1 END AS n_routes, CASE WHEN again THEN f2 ELSE f1 END AS last_failure,
           CASE WHEN s1 = 'translated' THEN {_body("primary", "fast", "s1", "f1", "r1")} WHEN again AND s2 = 'translated' THEN {_body("fallback", "strong", "s2", "f2", "r2")} END AS selected_route_id,
           CASE WHEN s1 = 'translated' THEN r1 WHEN again THEN r2 END AS result FROM c""")
def route_run(spark, sf_dir):
    """Each order as a job of two routes: answered, open, failed, not answered or answered twice by the first."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    jobs = orders.select(k.cast("string").alias("job_id"), (k % 50 + 1).cast("long").alias("n_tokens"))
    first = F.when(k % 5 == 0, "research_needed").when(k % 3 == 0, "failed").otherwise("translated")
    second = F.when(k % 2 == 0, "translated").otherwise("failed")

    def answers(model, status, failure):
        rows = orders.withColumns({"status": status, "failure_code": F.when(status == "failed", failure)})
        said = F.when(F.col("status") == "translated", F.concat(F.lit(f"{model} "), k.cast("string")))
        return rows.select(k.cast("string").alias("job_id"), "status", "failure_code", (k % 40).cast("long").alias("n_tokens"), said.alias("result"), "o_orderkey")

    fast = answers("fast", first, "http_permanent").where(k % 7 != 0)
    fast = fast.unionByName(fast.where(k % 11 == 0)).drop("o_orderkey")
    strong = answers("strong", second, "http_transient").drop("o_orderkey")
    steps = (runs.Pass("primary", "fast", runs.recorded(fast), repeatable=True), runs.Pass("fallback", "strong", runs.recorded(strong), repeatable=True))
    made = runs.run_routes(jobs, runs.new_root(spark, "routes"), *steps)
    return made.select("job_id", "status", F.size("routes").alias("n_routes"), F.element_at("routes", -1)["failure_code"].alias("last_failure"), "selected_route_id", "result")


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CASE WHEN o_orderkey % 4 = 0 THEN 'failed' ELSE 'judged' END AS status,
           CASE WHEN o_orderkey % 4 = 0 THEN 'provider_response_invalid' END AS failure_code, o_orderkey % 9 + 1 AS n_tokens,
           CASE WHEN o_orderkey % 4 > 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'fail' ELSE 'pass' END END AS result
    FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def judge_run(spark, sf_dir):
    """Judgements of orders in one pass: stopped by its budget before it starts, and taken up with a larger one."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    jobs = orders.select(k.cast("string").alias("job_id"), (k % 9 + 1).cast("long").alias("n_tokens"))
    said = orders.where(k % 4 > 0).select(
        k.cast("string").alias("job_id"), F.lit("judged").alias("status"), F.lit(None).cast("string").alias("failure_code"),
        (k % 9 + 1).cast("long").alias("n_tokens"), F.when(k % 3 == 0, "fail").otherwise("pass").alias("result"),
    )
    root = runs.new_root(spark, "judge")
    source = runs.prepared(jobs, root)
    try:
        runs.run_pass(spark, source, root, runs.Pass("judge", "mini", runs.recorded(said), budget=0, repeatable=True))
    except runs.BudgetReached:
        pass
    done = runs.run_pass(spark, source, root, runs.Pass("judge", "mini", runs.recorded(said), repeatable=True))
    return done.select("job_id", "status", "failure_code", "n_tokens", "result")
