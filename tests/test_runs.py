"""Runs that are cut and taken up again."""

import pytest
from pyspark.sql import functions as F

from marlstone.operators import runs

JOBS = "job_id string, n_tokens long"


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame([(f"j{i}", 10) for i in range(120)], JOBS).repartition(6, "job_id")


def answers(spark, model, status):
    rows = [(f"j{i}", status(i), "http_transient" if status(i) == "failed" else None, 10, f"{model} {i}") for i in range(120)]
    return spark.createDataFrame(rows, "job_id string, status string, failure_code string, n_tokens long, result string")


class Cut:
    """A transport that is cut in its ``at``-th call, and what it was asked."""

    def __init__(self, rows, at=0):
        self.rows, self.at, self.asked = rows, at, []

    def __call__(self, batch):
        self.asked.append({r.job_id for r in batch.select("job_id").collect()})
        if len(self.asked) == self.at:
            raise ConnectionError("cut")
        return runs.recorded(self.rows)(batch)


def both(spark, cut_first=0, cut_second=0):
    first = Cut(answers(spark, "a", lambda i: ("translated", "failed", "research_needed")[i % 3]), cut_first)
    second = Cut(answers(spark, "b", lambda i: "translated" if i % 2 else "failed"), cut_second)
    return first, second, (runs.Pass("primary", "a", first, repeatable=True), runs.Pass("fallback", "b", second, repeatable=True))


def plain(rows):
    return sorted(r.asDict(recursive=True).items().__repr__() for r in rows.collect())


def test_a_cut_run_goes_on_and_gives_the_rows_of_a_whole_one(spark, jobs, tmp_path):
    *_, steps = both(spark)
    whole = runs.run_routes(jobs, f"file://{tmp_path}/whole", *steps, files_per_batch=2)
    states = {r.job_id: (r.status, len(r.routes), r.result) for r in whole.collect()}
    for i in range(120):
        want = ("translated", 1, f"a {i}") if i % 3 == 0 else ("translated", 2, f"b {i}") if i % 2 else ("needs_review", 2, None)
        assert states[f"j{i}"] == want
    root = f"file://{tmp_path}/cut"
    first, second, steps = both(spark, 2, 1)
    for _ in range(2):
        with pytest.raises(Exception, match="cut"):
            runs.run_routes(jobs, root, *steps, files_per_batch=2)
    assert plain(runs.run_routes(jobs, root, *steps, files_per_batch=2)) == plain(whole)
    # the first batch was asked once, the one that was cut twice, and a finished run asks nothing
    counts = {j: sum(j in a for a in first.asked) for a in first.asked for j in a}
    assert all(counts[j] == 1 for j in first.asked[0]) and all(counts[j] == 2 for j in first.asked[1])
    n = len(first.asked) + len(second.asked)
    assert plain(runs.run_routes(jobs, root, *steps, files_per_batch=2)) == plain(whole)
    assert len(first.asked) + len(second.asked) == n


def test_what_may_have_been_sent_is_never_sent_again(spark, jobs, tmp_path):
    root = f"file://{tmp_path}"
    cut = Cut(answers(spark, "a", lambda i: "translated"), 2)
    step, source = runs.Pass("primary", "a", cut), runs.prepared(jobs, root)
    with pytest.raises(Exception, match="cut"):
        runs.run_pass(spark, source, root, step, 2)
    got = {r.job_id: r for r in runs.run_pass(spark, source, root, step, 2).collect()}
    unsure = {j for j, r in got.items() if r.failure_code == "network_delivery_unknown"}
    assert len(got) == 120 and unsure == cut.asked[1]
    assert all(sum(j in a for a in cut.asked) == 1 for j in got)
    routed = runs.routed(spark.createDataFrame(list(got.values()), runs.RECEIPT), runs.receipts(spark, root, "none"))
    assert {r.job_id for r in routed.where("status = 'needs_review'").collect()} == unsure


def test_a_budget_stops_before_it_is_passed_and_the_run_goes_on_with_more(spark, jobs, tmp_path):
    root = f"file://{tmp_path}"
    cut = Cut(answers(spark, "a", lambda i: "translated"))
    source = runs.prepared(jobs, root)
    with pytest.raises(runs.BudgetReached):
        runs.run_pass(spark, source, root, runs.Pass("primary", "a", cut, budget=900), 2)
    spent = runs.receipts(spark, root, "primary").agg(F.sum("n_tokens")).first()[0]
    assert 0 < spent <= 900
    assert runs.run_pass(spark, source, root, runs.Pass("primary", "a", cut, budget=1200), 2).count() == 120
    assert all(sum(j in a for a in cut.asked) == 1 for a in cut.asked for j in a)


def test_odd_jobs_and_answers(spark, tmp_path):
    rows = answers(spark, "a", lambda i: "translated")
    made = lambda ids, name: runs.run_pass(
        spark, runs.prepared(spark.createDataFrame([(j, 1) for j in ids], JOBS), f"file://{tmp_path}/{name}"), f"file://{tmp_path}/{name}",
        runs.Pass("primary", "a", runs.recorded(rows.unionByName(rows.where("job_id = 'j1'"))), repeatable=True),
    )
    assert made([], "none").count() == 0
    codes = {r.job_id: (r.status, r.failure_code, r.n_tokens) for r in made(["j0", "j1", "x"], "some").collect()}
    assert codes == {"j0": ("translated", None, 10), "j1": ("failed", "malformed_response", 10), "x": ("failed", "provider_response_invalid", 1)}
    for bad in (["j0", None], ["j0", "j0"]):
        with pytest.raises(Exception, match="a job"):
            made(bad, f"bad{len(set(bad))}")
