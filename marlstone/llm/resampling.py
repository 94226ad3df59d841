"""Importance resampling of documents towards a trusted target.

A document's log weight is its log-likelihood under the target's hashed n-gram model less
that under the raw corpus'.  Adding Gumbel noise, drawn from a hash of the seed and the
doc_id, and taking the k largest samples k documents without replacement, in proportion to
their weights.  The k-th largest key is found by counting in 2^16 ranges of the keys, three
times finer each time, so nothing is sorted or collected but those counts.

Defined results: null text has no n-grams and log weight 0; without trusted rows all log
weights are 0; equal keys are taken by a second hash of the doc_id, then by doc_id, null last; rows
with a null doc_id draw their noise by their text; repeated rows draw the same noise and are
told apart by a count; a text of any length counts whole; an empty table gives no row; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, hinted, let, text_of, words_of
from .ngram_model import BUCKETS, ID_BYTES, grams, literal_array, log_ratios, trusted_ids, weight_sum

FRACTION = 0.85
_SCALE = 1_000_000


def threshold(df: DataFrame, key: str, k: int) -> tuple[int, int]:
    """The k-th largest value of a long column, and how many rows lie above it."""
    above, low = 0, -(1 << 63)
    for shift in (48, 32, 16, 0):
        span = F.col(key).between(low, min(low + (1 << (shift + 16)) - 1, (1 << 63) - 1))
        part = df.where(span).groupBy(F.shiftright(F.col(key), shift).alias("r")).agg(F.count("*").alias("n"))
        for row in sorted(part.collect(), key=lambda r: -r.r):
            if above + row.n >= k:
                low = row.r << shift
                break
            above += row.n
    return low, above


def top_k(df: DataFrame, key: str, tie: str, k: int) -> DataFrame:
    """``df`` with a boolean ``selected`` on exactly k rows: the largest keys, then ties."""
    if k <= 0:
        return df.withColumn("selected", F.lit(False))
    low, above = threshold(df, key, k)
    equal = df.where(F.col(key) == low)
    low_tie, above_tie = threshold(equal, tie, k - above)
    left = k - above - above_tie
    chosen: Column = (F.col(key) > low) | ((F.col(key) == low) & (F.col(tie) > low_tie))
    last = (F.col(key) == low) & (F.col(tie) == low_tie)
    # rows with one key and one hash: copies of a row, told apart by a count
    rank = F.row_number().over(Window.partitionBy(key, tie).orderBy(F.col("doc_id").asc_nulls_last()))
    some = df.where(last).withColumn("selected", rank <= left)
    return df.where(~last).withColumn("selected", chosen).unionByName(some)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    fraction: float = FRACTION,
    seed: int = 7,
    buckets: int = BUCKETS,
    target_rows: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_grams, log_weight, gumbel_key, selected."""
    target = hinted(trusted_ids(labels, target_rows), ID_BYTES)
    number = F.col("doc_id").cast("long")
    own = F.when(number.isNull(), F.xxhash64(text_of(docs))).otherwise(number)
    words = docs.select(number.alias("doc_id"), own.alias("_own"), words_of(text_of(docs)).alias("_words"))
    marked = words.join(target, F.col("doc_id") == F.col("_target_id"), "left").select(
        F.col("_target_id").isNotNull().alias("trusted"), "_words"
    )
    ratios = log_ratios(marked, buckets)
    weights = literal_array(ratios or [0.0] * buckets)
    n = F.size("_words")
    score = let(grams(F.col("_words"), buckets), lambda g: weight_sum(g, weights))
    # 52 bits of a hash as a number in (0, 1)
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("_own")), 12) + 0.5) / float(1 << 52)
    key = F.col("log_weight") - F.log(-F.log(unit))
    rows = cut(
        words.select("doc_id", "_own", F.greatest(2 * n - 1, F.lit(0)).cast("long").alias("n_grams"), score.alias("log_weight"))
        .withColumn("gumbel_key", F.round(key * _SCALE).cast("long"))
        .withColumn("_tie", F.xxhash64(F.lit(seed + 1), F.col("_own"))),
        "weights",
    )
    k = int(-(-rows.count() * int(fraction * 10_000) // 10_000))
    return top_k(rows, "gumbel_key", "_tie", k).select(
        "doc_id", "n_grams", "log_weight", (F.col("gumbel_key") / _SCALE).alias("gumbel_key"), "selected"
    )
