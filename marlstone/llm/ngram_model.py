"""Hashed word n-gram multinomials of a trusted target and of the raw corpus.

Both models count words and neighbouring word pairs in ``buckets`` hash buckets, so the
model's size is fixed whatever the corpus.  The raw counts cover every row; the target's
are those of every trusted row that is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

BUCKETS = 1 << 16
#: What an id and its role take in a broadcast table, by estimate.
ID_BYTES = 24


def trusted_ids(labels: DataFrame, target_rows: int | None = None) -> DataFrame:
    """Ids of the trusted rows: quality 1, not toxic; with ``target_rows``, so many of them at most, chosen by a hash of the id."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    ids = good.select(F.col("doc_id").cast("long").alias("_target_id")).distinct()
    return ids if target_rows is None else ids.orderBy(F.xxhash64("_target_id"), "_target_id").limit(target_rows)


def labelled_ids(labels: DataFrame, rows: int | None = None, seed: int = 11) -> DataFrame:
    """(_target_id, role) of all labelled ids that are not toxic; with ``rows``, of so many at most, chosen by a hash of the id.

    role: target or held for trusted ids, half each by the hash; junk for ids of quality 0.
    An id whose label rows differ has its least quality and counts as toxic if one says so.
    """
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_target_id"))
    one = one.agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")).where("quality in (0, 1) and toxic = 0")
    spread = F.xxhash64(F.lit(seed), F.col("_target_id"))
    role = F.when(F.col("quality") == 0, "junk").when(F.pmod(spread, F.lit(2)) == 0, "target").otherwise("held")
    marked = one.select("_target_id", role.alias("role"))
    return marked if rows is None else marked.orderBy(spread, "_target_id").limit(rows)


def grams(words: Column, buckets: int = BUCKETS) -> Column:
    """Hash buckets of all words and all pairs of neighbours of an array of words."""

    def of(w: Column) -> Column:
        ones = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
        pairs = F.zip_with(
            F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
            F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
            lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"),
        )
        return F.concat(ones, pairs)

    return let(words, of)


def log_ratios(rows: DataFrame, buckets: int = BUCKETS, alpha: float = 1.0, mass: float | None = None) -> list[float] | None:
    """log P(bucket | target) - log P(bucket | raw) for each bucket, both smoothed by ``alpha``.

    With ``mass`` the target is smoothed towards the raw model instead, whose say is ``mass``
    times the target's grams: a bucket that the target lacks then costs log(mass / (1 + mass))
    however rare it is, and no bucket costs more.

    ``rows`` has an array column ``_words`` and a boolean ``trusted``.  Only the ``buckets``
    sums reach the driver.  None where the target has no gram.  The buckets are those of
    :func:`grams`, made row by row in generated code rather than in lambdas.
    """
    import numpy as np

    after = F.concat(F.slice("_words", 2, F.greatest(F.size("_words") - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    words = rows.select("trusted", F.explode(F.arrays_zip(F.col("_words").alias("a"), after.alias("b"))).alias("w"))
    words = words.where("w.a is not null").select("trusted", F.col("w.a").alias("a"), F.col("w.b").alias("b"))
    one = F.pmod(F.xxhash64("a"), F.lit(buckets))
    pair = F.when(F.col("b").isNotNull(), F.pmod(F.xxhash64("a", "b"), F.lit(buckets)))
    counts = (
        words.select("trusted", F.explode(F.array(one, pair)).alias("bucket"))
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum(F.col("trusted").cast("long")).alias("target"))
        .collect()
    )
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in counts:
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not target.sum():
        return None
    p = (target + alpha) / (target.sum() + alpha * buckets)
    q = (raw + alpha) / (raw.sum() + alpha * buckets)
    if mass is not None:
        p = (target + mass * target.sum() * q) / ((1 + mass) * target.sum())
    return [float(x) for x in np.log(p / q)]


def literal_array(values: list[float]) -> Column:
    """A constant array; the optimizer folds it to one literal before anything runs."""
    return F.split(F.lit(",".join(f"{v:.6f}" for v in values)), ",").cast("array<double>")


def weight_sum(gram_array: Column, weights: Column) -> Column:
    """Sum of the weights of an array of buckets (0 for none), folded in array order."""
    return F.aggregate(gram_array, F.lit(0.0), lambda acc, b: acc + F.get(weights, b))
