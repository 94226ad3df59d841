"""The closed catalogue of diagnostic codes, and the join that gives a code its meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Code, stage, severity.  No code is retryable.
CATALOGUE = (
    ("PARSE_INVALID_JSON", "ingest", "error"),
    ("PARSE_DUPLICATE_KEY", "ingest", "error"),
    ("PARSE_NON_FINITE_NUMBER", "ingest", "error"),
    ("PARSE_INVALID_UTF8", "ingest", "error"),
    ("PARSE_INVALID_UNICODE", "ingest", "error"),
    ("PARSE_EMPTY_RECORD", "ingest", "error"),
    ("PARSE_RECORD_TOO_LARGE", "ingest", "error"),
    ("SCHEMA_EXPECTED_OBJECT", "ingest", "error"),
    ("SCHEMA_CANONICAL_INVALID", "canonicalize", "error"),
    ("SCHEMA_UNSUPPORTED_KEYWORD", "registry", "error"),
    ("SCHEMA_DUPLICATE_SET_VALUE", "registry", "error"),
    ("TOOL_DEFINITION_INVALID", "registry", "error"),
    ("TOOL_NAME_UNRESOLVED", "canonicalize", "error"),
    ("TOOL_ARGUMENT_SCHEMA_INVALID", "canonicalize", "error"),
    ("SOURCE_ADAPTER_MISSING_FIELD", "adapter", "error"),
    ("SOURCE_ADAPTER_INVALID_FIELD", "adapter", "error"),
    ("SOURCE_ARG_NOT_GROUNDED", "source_semantic", "error"),
    ("CONFLICT_ORDER_AMBIGUITY", "dedup", "warning"),
    ("RELEASE_ARTIFACT_EXISTS", "publish", "error"),
    ("RELEASE_ARTIFACT_VALIDATION_FAILED", "publish", "error"),
    ("RELEASE_EVENT_CHAIN_INVALID", "events", "error"),
)
# End of fixed values.


def described(rows: DataFrame, code: str = "code") -> DataFrame:
    """``rows`` with stage, severity and retryable of their code; ``known`` is false for a code that is not listed.

    The catalogue is 21 rows, broadcast.
    """
    spark = rows.sparkSession
    listed = spark.createDataFrame(list(CATALOGUE), f"{code} string, stage string, severity string").withColumn("retryable", F.lit(False))
    return rows.join(F.broadcast(listed), code, "left").withColumn("known", F.col("stage").isNotNull())
