"""Exact deduplication by skew-safe combining, JVM expressions only.

Texts are equal when identical after white space is deleted.  Three stages, each of
which groups by the digest *and* the whole normalised text, so equality is always that
of full content and never of digests alone:

1. locally: the map-side half of the first aggregation combines the copies inside an
   input partition before anything is shuffled;
2. salted: copies of one digest meet in up to ``salts`` groups, by their input partition and
   not by their ids, so one text that makes up a third of all rows is combined by many
   tasks, also where ids are null or repeated;
3. globally: the few salt winners of a digest (at most ``salts`` for each text) meet.

Rows learn their group through ``(digest, salt)``, again at most one salt's share of a
digest to a key.  Two different texts with one digest are told apart: stage 3 numbers the
texts of each digest, and rows of such digests are resolved by a join on content.

Defined results: null text counts as empty; all empty texts are one group; of equal
texts the row with the most code points wins, then the smallest doc_id, a null doc_id
last; among identical rows with one doc_id exactly one is kept; a text of any length is
compared whole; an empty table gives no row; the input's other columns come back unchanged
whatever their names (``drop_copies``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, Tidy, cut, hinted, text_of

_BIAS = 2**63
_IDS = 2**65


def _prepared(docs: DataFrame, salts: int, digest_bits: int) -> DataFrame:
    text = text_of(docs)
    norm = F.regexp_replace(text, f"[{WS}]+", "")
    doc_id = F.col("doc_id").cast("long")
    # a partition's rows share a salt, whatever their ids, so that the local stage combines
    # them; both uses of these rows see the same partitions, as docs come from files
    salt = F.pmod(F.hash(F.spark_partition_id()), F.lit(salts))
    base = docs.select(
        doc_id.alias("doc_id"), salt.cast("int").alias("salt"), F.length(text).alias("chars"), norm.alias("norm")
    )
    full = F.sha2("norm", 256)
    digest = full if digest_bits == 256 else F.substring(full, 1, digest_bits // 4)
    # one number that orders rows by length downwards, then by id: the aggregates below
    # then keep to fixed-width buffers
    rank = F.expr(
        f"cast(2147483648 - chars as decimal(11,0)) * {_IDS}BD + coalesce(cast(doc_id as decimal(20,0)) + {_BIAS}BD, {2 * _BIAS}BD)"
    )
    return base.select("*", full.alias("sha"), digest.alias("digest"), rank.cast("decimal(34,0)").alias("rank"))


def exact_groups(docs: DataFrame, salts: int = 64, digest_bits: int = 256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` must come from files, so that its partitions stay; a row that finds no group
    all the same fails the query instead of being lost.  ``digest_bits`` below 256 only
    serves tests of colliding digests.
    """
    rows = _prepared(docs, salts, digest_bits)
    salted = rows.groupBy("digest", "salt", "norm").agg(F.count("*").alias("n"), F.min("rank").alias("rank"))
    same = Window.partitionBy("digest", "norm")
    each = Window.partitionBy("digest").orderBy("norm")
    groups = cut(
        salted.select(
            "digest",
            "salt",
            F.dense_rank().over(each).alias("variant"),
            F.sum("n").over(same).alias("group_size"),
            F.min(F.struct("rank", "salt")).over(same).alias("first"),
            F.col("norm"),
        )
        .withColumn("variants", F.max("variant").over(Window.partitionBy("digest")))
        .withColumn("norm", F.when(F.col("variants") > 1, F.col("norm")))
        # of the salts that hold the best rank one holds the row that stays
        .select("*", F.col("first.rank").alias("best"), (F.col("first.salt") == F.col("salt")).alias("here"))
        .drop("first"),
        "exact-groups",
    )
    plain = groups.where("variants = 1").select("digest", "salt", "group_size", "best", "here")
    several = groups.where("variants > 1").select("digest", "salt", "norm", "group_size", "best", "here")
    lean = rows.select("doc_id", "salt", "digest", "sha", "rank")
    if several.isEmpty():
        joined = lean.join(plain, ["digest", "salt"], "left")
    else:
        joined = rows.select("doc_id", "salt", "digest", "sha", "rank", "norm").join(
            plain.withColumnRenamed("group_size", "_size").withColumnRenamed("best", "_best").withColumnRenamed("here", "_here"),
            ["digest", "salt"],
            "left",
        )
        joined = joined.join(several, ["digest", "salt", "norm"], "left").select(
            "doc_id", "salt", "digest", "sha", "rank", F.coalesce("_size", "group_size").alias("group_size"),
            F.coalesce("_best", "best").alias("best"), F.coalesce("_here", "here").alias("here"),
        )
    best_id = F.expr(f"best % {_IDS}BD")
    keep = F.when(best_id < F.expr(f"{2 * _BIAS}BD"), (best_id - F.expr(f"{_BIAS}BD")).cast("long"))
    # the join leaves rows dealt by (digest, salt), which this window needs: no new exchange
    twin = F.row_number().over(Window.partitionBy("digest", "salt", "rank", "doc_id").orderBy("sha"))
    lost = F.raise_error(F.lit("a row's partition changed between two reads: the input must come from files")).cast("long")
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.when(F.col("group_size").isNull(), lost).otherwise(F.col("group_size").cast("long")).alias("group_size"),
        (F.col("here") & (F.col("rank") == F.col("best")) & (twin == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, salts: int = 64) -> DataFrame:
    """The documents that stay, with all their columns.

    The losers' keys are broadcast while they are few and joined by a shuffle beyond
    that.  Where a row is repeated with its doc_id, one of its rows stays.
    """
    key = lambda d: d.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    same = (F.col("l._id").eqNullSafe(F.col("r._id"))) & (F.col("l._sha") == F.col("r._sha"))
    with Tidy() as tidy:
        groups = cut(exact_groups(docs, salts), "exact-members")
        winners, losers = key(groups.where("kept")), key(groups.where("not kept")).distinct()
        twins = cut(losers.alias("l").join(winners.alias("r"), same, "left_semi"), "exact-twins")
        gone = cut(losers.alias("l").join(winners.alias("r"), same, "left_anti"), "exact-gone")
        tidy.keep(twins, gone)
    text = text_of(docs)
    marked = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.sha2(F.regexp_replace(text, f"[{WS}]+", ""), 256).alias("_sha"),
        F.struct(*docs.columns).alias("_own"),
    )
    out = marked.alias("l").join(hinted(gone, 96).alias("r"), same, "left_anti")
    if not twins.isEmpty():
        few = hinted(twins, 96)
        again = out.alias("l").join(few.alias("r"), same, "left_semi")
        best = Window.partitionBy("_id", "_sha").orderBy(F.length("_own.text").desc(), "_own.text")
        one = again.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")
        out = out.alias("l").join(few.alias("r"), same, "left_anti").unionByName(one)
    return out.select("_own.*")
