"""Quality rules: counted base rules, then a likelihood-ratio test, JVM expressions only.

A document's score is the log-likelihood ratio of its hashed words and word pairs under
the trusted target's multinomial and the raw corpus', divided by their number.  The two
models have a fixed number of buckets; the raw one counts every document.  The target is
counted over half of the trusted rows and smoothed towards the raw model, so what it never
saw says little.  A document stays when it passes the base rules and its score is at least a
threshold, found on labelled rows that the target never saw: half way between what 98 % of
the held-out trusted rows reach and what 98 % of the junk rows stay below.

Defined results: null text has no words and no lines; documents without words fail the
base rules (fewer than ``min_words``); without trusted rows the base rules alone decide;
with held-out rows of one kind only their own mark is the threshold, without any ``THRESHOLD``;
repeated rows, rows with a null doc_id and ties at the threshold (kept) are treated like
others; a text of any length counts whole; an empty table gives no row.  The input's columns
come back unchanged whatever their names: all that is computed is in one struct beside them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, cut, drop, hinted, let, text_of, words_of
from .ngram_model import BUCKETS, ID_BYTES, grams, labelled_ids, literal_array, log_ratios, weight_sum

#: The target's share of the raw model in its own, by its number of grams.
MASS = 1.0
#: Half of the least score there is with that mass, log(1/2).
THRESHOLD = -0.35
#: Which part of held-out trusted rows may lie below their mark, and of junk rows above theirs.
MISSED = 0.02
#: Cells of one unit of score in which held-out rows are counted.
CELLS = 4096
_LONGS = "array<bigint>"


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are compared by 64-bit hash.  Few repeated windows are looked up in their
    list, many are found by sorting (hash, position), so long texts stay n log n.
    """

    def covered(starts: Column) -> Column:
        step = lambda acc, p: F.struct(
            (acc["sum"] + (p + 3) - F.greatest(acc["end"], p)).alias("sum"), (p + 3).alias("end")
        )
        zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end"))
        return F.aggregate(starts, zero, step, lambda acc: acc["sum"])

    def by_list(t: Column, twice: Column) -> Column:
        return covered(
            F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: F.array_contains(twice, F.get(t, i)))
        )

    def by_sort(t: Column) -> Column:
        pairs = F.sort_array(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def found(s: Column) -> Column:
            kin = F.filter(
                F.sequence(F.lit(0), F.size(s) - 1),
                lambda k: ((k > 0) & (F.get(s, k - 1)["h"] == F.get(s, k)["h"]))
                | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == F.get(s, k)["h"])),
            )
            return covered(F.sort_array(F.transform(kin, lambda k: F.get(s, k)["i"])))

        return let(pairs, found)

    def of_hashes(t: Column) -> Column:
        twice = let(
            F.sort_array(t),
            lambda s: F.array_distinct(F.filter(s, lambda h, i: (i > 0) & (F.get(s, i - 1) == h))),
        )
        return F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(
            let(twice, lambda d: F.when(F.size(d) <= 16, by_list(t, d)).otherwise(by_sort(t)))
        )

    hashes = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    return let(
        words,
        lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes(w), of_hashes)),
    ).cast("long")


def _without(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[{chars}]+", ""))


def base_counts(text: Column, words: Column) -> dict[str, Column]:
    """The counted values of the base rules by name."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WS}]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": _without(text, WS).cast("long"),
        "n_symbols": (F.length(text) - _without(text, r"#*$%&|<>")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(words),
    }


def _score(words: Column, weights: Column, buckets: int) -> Column:
    """The mean weight of a text's grams, 0 where it has none."""
    return let(grams(words, buckets), lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(weight_sum(g, weights) / F.size(g)))


def _base_failed(n_words: Column, n_repeat_words: Column, min_words: int, max_repeat_percent: int) -> Column:
    return (n_words < min_words) | (100 * n_repeat_words > max_repeat_percent * n_words)


def _mark(scores: DataFrame, cells: list[tuple[int, int]], share: float) -> float | None:
    """The exact percentile of ``scores`` (score), interpolated, given the number of rows of each of its cells in order.

    Only the rows of the one or two cells that hold it are looked at.
    """
    position = share * (sum(n for _, n in cells) - 1)
    if not cells:
        return None
    before, wanted, at = None, [], 0
    for cell, n in cells:
        if at + n > math.floor(position) and at <= math.ceil(position):
            before = at if before is None else before
            wanted.append(cell)
        at += n
    values = scores.where(_cell().isin(wanted)).groupBy("score").count().collect()
    ends, at = [], before
    for score, n in sorted(map(tuple, values)):
        ends += [score for rank in (math.floor(position), math.ceil(position)) if at <= rank < at + n]
        at += n
    return ends[0] + (position - math.floor(position)) * (ends[-1] - ends[0])


def _cell() -> Column:
    return F.floor(F.col("score") * CELLS)


def _found_threshold(held: DataFrame, missed: float) -> float:
    """The threshold that all held-out rows (role, score) set; counts by cell of score and the values of a few cells reach the driver."""
    made = cut(held, "held")  # not filtered before, as a filter on the score would run below the join on every text
    scored = made.where("score is not null")
    counts = scored.groupBy("role", _cell().alias("cell")).count().collect()
    marks = []
    for role, share in (("held", missed), ("junk", 1 - missed)):
        own = sorted((r["cell"], r["count"]) for r in counts if r["role"] == role)
        marks.append(_mark(scored.where(F.col("role") == role), own, share))
    drop(made)
    marks = [m for m in marks if m is not None]
    return sum(marks) / len(marks) if marks else THRESHOLD


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float | None = None,
    buckets: int = BUCKETS,
    target_rows: int | None = None,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    mass: float = MASS,
    missed: float = MISSED,
    out: str = "_quality",
) -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: the base counts, base_failed, score and kept.

    Every labelled id counts unless ``target_rows`` is given: the target's for the model, all held-out
    ones for the threshold.  They are broadcast where they are few, else joined by a shuffle; the model is
    ``buckets`` doubles (0.5 MB).
    """
    if out in docs.columns:
        raise ValueError(f"the input has a column {out} already; name another by out=")
    own = F.struct(*docs.columns).alias("_own")
    rows = docs.select(own, text_of(docs).alias("_text"), F.col("doc_id").cast("long").alias("_doc_id"))
    rows = rows.withColumn("_words", words_of(F.col("_text")))
    known = cut(labelled_ids(labels, target_rows), "labelled")
    # texts are joined, and words made of them above the join: fewer bytes where it is a shuffle
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc_id"), text_of(docs).alias("_text"))
    marked = texts.join(hinted(known.where("role = 'target'"), ID_BYTES), F.col("_doc_id") == F.col("_target_id"), "left")
    ratios = log_ratios(marked.select(F.col("_target_id").isNotNull().alias("trusted"), words_of(F.col("_text")).alias("_words")), buckets, mass=mass)
    counted = rows.withColumns(base_counts(F.col("_text"), F.col("_words"))).withColumn(
        "base_failed", _base_failed(F.col("n_words"), F.col("n_repeat_words"), min_words, max_repeat_percent)
    )
    if ratios is None:
        scored = counted.withColumn("score", F.lit(0.0)).withColumn("kept", ~F.col("base_failed"))
    else:
        weights = literal_array(ratios)
        if threshold is None:
            # the held-out rows are found before anything is made of a text
            held = texts.join(hinted(known.where("role <> 'target'"), ID_BYTES), F.col("_doc_id") == F.col("_target_id"))
            held = held.select("role", words_of(F.col("_text")).alias("_words"))
            # as a value, not a filter, which would run below the join on every text
            failed = _base_failed(F.size("_words"), repeat_words(F.col("_words")), min_words, max_repeat_percent)
            threshold = _found_threshold(held.select("role", F.when(~failed, _score(F.col("_words"), weights, buckets)).alias("score")), missed)
        scored = counted.withColumn("score", F.when(F.col("base_failed"), F.lit(None)).otherwise(_score(F.col("_words"), weights, buckets))).withColumn(
            "kept", ~F.col("base_failed") & (F.coalesce(F.col("score"), F.lit(0.0)) >= threshold)
        )
    drop(known)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return scored.select("_own.*", F.struct(*names).alias(out))
