"""Runs that can be taken up again: passes over jobs with receipts, a budget, and two routes.

A pass streams the files of a jobs table in bounded batches.  Each batch is answered once and
leaves one folder of receipts, whose manifest is written last; the stream's own log says which
batches are done.  A run that stops, for whatever reason, goes on with the batch it stopped in:
a batch with whole receipts is not answered again, one without is answered anew if its
transport may be asked twice (recorded answers), and else left to a person, as it may have been sent.

Nothing here sends anything itself; a transport is a function of DataFrames.

Defined results: jobs with a null or repeated key fail the run; an empty jobs table gives no
receipts; jobs without an answer fail as ``provider_response_invalid``; answers to nothing asked
are ignored, and several answers to one job fail it as ``malformed_response``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.jcs import id_of, json_string, obj
from .evaluation import needs_fallback

#: Versions in ids, and the two routes in their order.
ROUTE_VERSION = "autonomous-route-0.1.0"
ROUTES = ("primary", "fallback")
#: What an answer says of its job; ``failure_code`` is null unless it failed.
ANSWER = "job_id string, status string, failure_code string, n_tokens long, result string"
RECEIPT = f"batch long, route string, model string, {ANSWER}, route_id string"

Transport = Callable[[DataFrame], DataFrame]


class BudgetReached(RuntimeError):
    """The next batch would take more tokens than are left; the run goes on when there are more."""


@dataclass(frozen=True)
class Pass:
    """One pass: its name, the model asked, how it is asked, and what it may spend.

    ``budget`` bounds the sum of the receipts' tokens and the estimates of the next batch; ``repeatable``
    says that a question may be sent twice.
    """

    route: str
    model: str
    transport: Transport = field(repr=False)
    budget: int | None = None
    repeatable: bool = False


def _route_id(step: Pass) -> Column:
    body = obj(
        schema_version=F.lit(f'"{ROUTE_VERSION}"'), episode_id=json_string(F.col("job_id")), route=json_string(F.lit(step.route)),
        model=json_string(F.lit(step.model)), status=json_string(F.col("status")), failure_code=json_string(F.col("failure_code")), translation_result=json_string(F.col("result")),
    )
    return id_of("autoroute", body)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def receipts(spark: SparkSession, root: str, route: str) -> DataFrame:
    """All receipts of a route; none where it never ran."""
    folder = f"{root}/receipts/{route}"
    if not _exists(spark, folder):
        return spark.createDataFrame([], RECEIPT)
    return spark.read.schema(RECEIPT).option("recursiveFileLookup", "true").parquet(folder)


def prepared(jobs: DataFrame, root: str) -> str:
    """Write ``jobs`` (job_id, n_tokens: an estimate, and what the transport reads) once; its path.

    A run that is taken up again finds its jobs as they were, so that batches stay the same.
    """
    spark, path = jobs.sparkSession, f"{root}/jobs"
    if not _exists(spark, f"{path}/_SUCCESS"):
        same = F.count("*").over(Window.partitionBy("job_id"))
        wrong = F.when(F.col("job_id").isNull(), "a job without an id").when(same > 1, F.concat(F.lit("a job twice: "), F.col("job_id").cast("string")))
        said = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("string")).otherwise(F.col("job_id").cast("string"))
        jobs.withColumn("job_id", said).write.mode("overwrite").parquet(path)
    return path


def _answered(batch: DataFrame, step: Pass, number: int) -> DataFrame:
    """A receipt for each job of a batch."""
    given = step.transport(batch).groupBy("job_id").agg(F.count("*").alias("_n"), *(F.min(c).alias(f"_{c}") for c in ("status", "failure_code", "n_tokens", "result")))
    both = batch.select("job_id", F.col("n_tokens").alias("_asked")).join(given, "job_id", "left")
    code = F.when(F.col("_n").isNull(), "provider_response_invalid").when(F.col("_n") > 1, "malformed_response")
    clean = code.isNull()
    made = both.select(
        F.lit(number).cast("long").alias("batch"), F.lit(step.route).alias("route"), F.lit(step.model).alias("model"), "job_id",
        F.when(clean, F.col("_status")).otherwise("failed").alias("status"),
        F.when(clean, F.col("_failure_code")).otherwise(code).alias("failure_code"),
        F.coalesce("_n_tokens", "_asked").cast("long").alias("n_tokens"),
        F.when(clean, F.col("_result")).alias("result"),
    )
    return made.withColumn("route_id", _route_id(step))


def _unsure(batch: DataFrame, step: Pass, number: int) -> DataFrame:
    """Receipts of a batch that may have been sent: none is sent again, each is left to a person."""
    none = batch.select("job_id", F.lit("failed").alias("status"), F.lit("network_delivery_unknown").alias("failure_code"), F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("string").alias("result"))
    return _answered(batch, Pass(step.route, step.model, lambda _: none), number)


def run_pass(spark: SparkSession, source: str, root: str, step: Pass, files_per_batch: int = 64) -> DataFrame:
    """Answer the jobs in the folder ``source``, batch by batch; the receipts of the whole route.

    Raises BudgetReached before a batch that the budget does not hold; what was done stays done.
    """
    schema = spark.read.parquet(source).schema
    if not schema:
        return receipts(spark, root, step.route)
    stopped: list[BudgetReached] = []

    def settle(batch: DataFrame, number: int) -> None:
        here = f"{root}/receipts/{step.route}/batch={number}"
        if _exists(spark, f"{here}/_SUCCESS"):
            return
        claim = f"{root}/claims/{step.route}/batch={number}"
        claimed = _exists(spark, f"{claim}/_SUCCESS")
        if step.budget is not None and not claimed:
            spent = receipts(spark, root, step.route).agg(F.sum("n_tokens")).first()[0] or 0
            asked = batch.agg(F.sum("n_tokens")).first()[0] or 0
            if spent + asked > step.budget:
                stopped.append(BudgetReached(f"{step.route}: {spent} tokens spent, {asked} asked, {step.budget} in all"))
                raise stopped[-1]
        if not claimed:
            batch.select("job_id").write.mode("overwrite").parquet(claim)
        made = _unsure(batch, step, number) if claimed and not step.repeatable else _answered(batch, step, number)
        made.select(*T.StructType.fromDDL(RECEIPT).fieldNames()).write.mode("overwrite").parquet(here)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(settle).option("checkpointLocation", f"{root}/progress/{step.route}").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if stopped:
            raise stopped[-1] from None
        raise
    return receipts(spark, root, step.route)


def run_routes(jobs: DataFrame, root: str, primary: Pass, fallback: Pass, files_per_batch: int = 64) -> DataFrame:
    """Every job by the first route, those it may not settle by the second; one row for each job.

    Returns job_id, status (translated or needs_review), routes (route, status, failure_code, route_id in order),
    selected_route_id and result.  The fallback's jobs are written once the first route is through.
    """
    spark = jobs.sparkSession
    source = prepared(jobs, root)
    first = run_pass(spark, source, root, primary, files_per_batch)
    again = f"{root}/fallback-jobs"
    if not _exists(spark, f"{again}/_SUCCESS"):
        left = first.where(needs_fallback(F.col("status"), F.col("failure_code"))).select("job_id")
        spark.read.parquet(source).join(left, "job_id", "left_semi").write.mode("overwrite").parquet(again)
    second = run_pass(spark, again, root, fallback, files_per_batch)
    return routed(first, second)


def routed(first: DataFrame, second: DataFrame) -> DataFrame:
    """The result of each job of two routes' receipts."""
    one = F.struct("route", "status", "failure_code", "route_id").alias("r")
    b = second.select("job_id", one.alias("b"), F.col("result").alias("_second"))
    both = first.select("job_id", one.alias("a"), F.col("result").alias("_first")).join(b, "job_id", "left")
    done = lambda side: F.coalesce(F.col(f"{side}.status") == "translated", F.lit(False))
    chosen = lambda a, b: F.when(done("a"), a).when(done("b"), b)
    return both.select(
        "job_id",
        F.when(done("a") | done("b"), "translated").otherwise("needs_review").alias("status"),
        F.array_compact(F.array("a", "b")).alias("routes"),
        chosen(F.col("a.route_id"), F.col("b.route_id")).alias("selected_route_id"),
        chosen(F.col("_first"), F.col("_second")).alias("result"),
    )


def recorded(answers: DataFrame) -> Transport:
    """A transport that looks answers (job_id, status, failure_code, n_tokens, result) up in a table."""
    return lambda asked: answers.join(asked.select("job_id"), "job_id", "left_semi")


def new_root(spark: SparkSession, name: str) -> str:
    from .common import shared_folder

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
