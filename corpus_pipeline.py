"""Corpus pipeline: quality rules, exact dedup, near-duplicate dedup, PII, packing.

Defined results of all stages: null text counts as empty, so the first stage rejects it, and
with it every text of fewer than 50 words; rows with a null doc_id are documents like
others, but never near copies; of repeated rows one stays (second stage); a text of any
length is kept whole; an empty table gives no rows; the first four stages return the
columns of ``documents``, whatever their names, with ``text`` (and ``n_chars``) changed by the
fourth alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import exact_dedup, ngram_join, packing, pii, quality_rules
from marlstone.llm.common import Tidy, cut, drop, free_name, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    verdict = free_name(docs, "_quality")
    verdicts = quality_rules.quality_verdicts(docs, table(spark, sf_dir, "labels"), out=verdict)
    return verdicts.where(verdicts[verdict]["kept"]).select(*(F.col(f"`{c}`") for c in docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.drop_near_copies(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced in their texts."""
    return pii.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("pii", private),
    ("packing", packed),
]

#: Similarity components and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        with Tidy() as tidy:
            docs = cut(stage(spark, docs, sf_dir), name)
            tidy.keep(docs)
        if before is not None:
            drop(before)
        before = docs
    return docs
