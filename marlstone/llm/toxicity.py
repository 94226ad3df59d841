"""Toxicity by a logistic model that is held to the same score when identity terms are swapped.

Features of a text are its words in lower case and the beginnings of its words, each with
log(1 + 300 c / (n + 100)) for c occurrences among n words: what counts is how densely a text
holds them.  The fit takes labelled training rows only:

1. a sample of at most about ``TRAIN_ROWS`` rows, chosen by a hash of the id;
2. over the sample, sums of values by label for each feature; the ``FEATURES`` features whose means
   differ most between the labels, in units of their spread, are kept;
3. weights that minimise mean log loss + ridge / 2 |w|^2 + penalty / 2 mean (w x - w x')^2, the
   last over counterfactual pairs: x is what stands in a labelled row's sentences with an identity
   term, x' the same with each term swapped for another of its group.

So a group's name cannot carry weight of its own that another group's name does not, and a neutral
mention of it does not raise a score.  The sample's rows for the fit (at most ``FEATURES`` numbers
each) meet in one task, in the order of a hash; scoring is one pass over every document.

Defined results: a null text is scored as an empty one, which gets what the constant says; rows
with a null doc_id are scored, not held out, and never train; repeated rows count each; of several
labels of an id the highest holds; labels other than 0 and 1 and null ones are not used; a text of
any length is scored whole; without labelled rows of both classes every score is the share of
toxic rows, n / (all + 1); empty tables give no row; other columns, whatever their names, are not
read.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tidy, cut

#: Bounds of the fit: labelled rows, features; and what it weighs.
TRAIN_ROWS = 16_000
FEATURES = 1024
RIDGE = 0.3  # divided by the number of rows
PENALTY = 1.0
STEPS = 300

#: A document is held out where the remainder is 2; scores from 0.3 count as toxic.
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3

BEGINNINGS = (3, 4, 5, 6)
KEPT_WORDS = 300_000
_UNITS = 1000  # values are summed as whole thousandths, so that no order of summing matters

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")

#: Identity terms by group, in the four languages of the corpus; a term is swapped within its group.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("black", "white", "asian", "latino", "arab"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"), ("immigrants", "refugees", "foreigners", "natives"), ("old", "young", "disabled"),
    ("americans", "mexicans", "africans", "europeans", "chinese", "indians", "turks"),
    ("frauen", "männer"), ("muslime", "christen", "juden", "hindus"), ("schwule", "lesben", "heterosexuelle"), ("ausländer", "flüchtlinge", "einwanderer", "inländer"), ("türken", "deutsche", "polen", "afrikaner"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs", "hindous"), ("homosexuels", "lesbiennes", "hétérosexuels"), ("immigrés", "réfugiés", "étrangers"), ("arabes", "français", "africains", "asiatiques"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos", "hindúes"), ("homosexuales", "lesbianas", "heterosexuales"), ("inmigrantes", "refugiados", "extranjeros"), ("gitanos", "españoles", "africanos", "asiáticos"),
)


def word_features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]


def value(count: int, words: int) -> float:
    return math.log1p(300 * count / (words + 100))


def feature_values(text: str | None) -> dict[str, float]:
    """Every feature of a text with its value."""
    words = Counter(_WORD.findall((text or "").lower()))
    found: Counter[str] = Counter()
    for word, count in words.items():
        for feature in word_features(word):
            found[feature] += count
    total = words.total()
    return {feature: value(count, total) for feature, count in found.items()}


def swapped(text: str | None, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> tuple[str, str] | None:
    """The sentences of a text that hold an identity term, in lower case, and the same with each
    term swapped for the one that the text's checksum picks of its group; None without any."""
    group = _groups(terms)
    before = [s for s in _SENTENCE.findall((text or "").lower()) if not group.keys().isdisjoint(_WORD.findall(s))]
    if not before:
        return None
    whole = "\n".join(before)
    pick = zlib.crc32(whole.encode())

    def other(match: re.Match) -> str:
        own = group.get(match[0])
        return own[0][(own[1] + 1 + pick % (len(own[0]) - 1)) % len(own[0])] if own else match[0]

    return whole, _WORD.sub(other, whole)


@functools.lru_cache(maxsize=4)
def _groups(terms: tuple[tuple[str, ...], ...]) -> dict[str, tuple[tuple[str, ...], int]]:
    return {term: (group, place) for group in terms for place, term in enumerate(group) if len(group) > 1}


# -- the fit -------------------------------------------------------------------------
def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(key, text, y) of a sample of about ``rows`` labelled rows that are not held out, or of all if there are fewer."""
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    marks = marks.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) != HELD_OUT).groupBy("doc_id").agg(F.max("y").alias("y"))
    known = marks.count()
    share = min(1.0, rows / max(known, 1))
    key = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    marks = marks.withColumn("key", key).where(F.pmod(F.col("key"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return texts.join(marks, "doc_id").select("key", "text", "y")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sums: dict[str, list[int]] = {}
            for text, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                for feature, v in feature_values(text).items():
                    own = sums.setdefault(feature, [0, 0, 0])
                    own[y] += round(v * _UNITS)
                    own[2] += 1
            columns = [pa.array([v[k] for v in sums.values()], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string()), *columns], ["feature", "clean", "toxic", "rows"])


def select_features(sample: DataFrame, n_clean: int, n_toxic: int, features: int = FEATURES) -> list[str]:
    """At most ``features`` features, those that tell the labels apart best first."""
    sums = sample.select("text", "y").mapInArrow(_sums, "feature string, clean long, toxic long, rows long")
    sums = sums.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows")).where("rows >= 3")
    spread = F.sqrt((F.col("clean") + F.col("toxic") + _UNITS) / (n_clean + n_toxic))
    told = sums.select("feature", (F.abs(F.col("toxic") / n_toxic - F.col("clean") / n_clean) / spread).alias("told"))
    return [r.feature for r in told.orderBy(F.desc("told"), "feature").limit(features).collect()]


def _design(chosen: list[str], terms: tuple[tuple[str, ...], ...]):
    """Rows of the fit: chosen features of the text, and of what a swap of identity terms changes."""
    place = {feature: k for k, feature in enumerate(chosen)}

    def of(text: str | None) -> dict[int, float]:
        return {place[f]: v for f, v in feature_values(text).items() if f in place}

    def change(text: str | None) -> dict[int, float]:
        pair = swapped(text, terms)
        if pair is None:
            return {}
        before, after = map(of, pair)
        return {k: d for k in {**before, **after} if (d := after.get(k, 0.0) - before.get(k, 0.0))}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.int32()), pa.list_(pa.float32())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                both = [of(t) for t in texts], [change(t) for t in texts]
                columns = [pa.array([list(f(d)) for d in side], kind) for side in both for f, kind in zip((dict.keys, dict.values), lists)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("y"), *columns], ["key", "y", "at", "value", "change_at", "change"])

    return task


def _dense(at: list[list[int]], values: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(at), width), np.float32)
    for row, (k, v) in enumerate(zip(at, values)):
        out[row, k] = v
    return out


def fitted_weights(x: np.ndarray, y: np.ndarray, changes: np.ndarray, ridge: float, penalty: float, steps: int = STEPS) -> np.ndarray:
    """Weights, the constant last, by full-batch gradient steps with moments."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    changes = np.hstack([changes, np.zeros((len(changes), 1), np.float32)])
    w, mean, square = (np.zeros(x.shape[1]) for _ in range(3))
    w[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    free = np.r_[np.ones(x.shape[1] - 1), 0]
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (p - y) / len(y) + ridge / len(y) * w * free
        if len(changes):
            slope += penalty * (changes.T @ (changes @ w)) / len(changes)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


class Model:
    """Weights by feature and a constant; small enough to go with each task."""

    def __init__(self, weights: dict[str, float], constant: float) -> None:
        self.weights, self.constant = weights, constant

    def score(self, texts: list[str | None], words: _Words | None = None) -> list[float]:
        words = _Words(self.weights) if words is None else words
        out = []
        for text in texts:
            found = Counter(_WORD.findall((text or "").lower()))
            counts: Counter[str] = Counter()
            for word, count in found.items():
                for feature in words[word]:
                    counts[feature] += count
            total = found.total()
            logit = self.constant + math.fsum(self.weights[f] * value(c, total) for f, c in counts.items())
            out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, logit)))))
        return out


class _Words(dict):
    """The features with a weight, by word."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self._weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= KEPT_WORDS:
            self.clear()
        own = tuple(f for f in word_features(word) if f in self._weights)
        if len(word) < 64:
            self[word] = own
        return own


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, features: int = FEATURES, ridge: float = RIDGE, penalty: float = PENALTY, terms=IDENTITY_TERMS) -> Model:
    """The model of the labelled rows of ``docs`` that are not held out."""
    with Tidy():
        sample = cut(training_rows(docs, labels, rows), "toxicity-sample")
        n_clean, n_toxic = (r or 0 for r in sample.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first())
        if not n_clean or not n_toxic:
            share = n_toxic / (n_clean + n_toxic + 1)
            return Model({}, math.log(share / (1 - share)) if share else -700.0)
        chosen = select_features(sample, n_clean, n_toxic, features)
        design = sample.mapInArrow(_design(chosen, terms), "key long, y int, at array<int>, value array<float>, change_at array<int>, change array<float>")

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            y, x, changes = [np.empty(0)], [np.empty((0, len(chosen)), np.float32)], [np.empty((0, len(chosen)), np.float32)]
            for batch in batches:
                at, v, moved, change = (batch.column(k).to_pylist() for k in range(2, 6))
                y.append(batch.column("y").to_numpy().astype(float))
                x.append(_dense(at, v, len(chosen)))
                with_change = [k for k, m in enumerate(moved) if m]
                changes.append(_dense([moved[k] for k in with_change], [change[k] for k in with_change], len(chosen)))
            w = fitted_weights(np.vstack(x), np.concatenate(y), np.vstack(changes), ridge, penalty)
            yield pa.RecordBatch.from_arrays([pa.array([w.tolist()], pa.list_(pa.float64()))], ["w"])

        ordered = design.repartition(1).sortWithinPartitions("key", F.xxhash64("at", "value"))
        weights = ordered.mapInArrow(task, "w array<double>").first().w
    return Model(dict(zip(chosen, weights)), weights[-1])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(model.weights)
        for batch in batches:
            found = pa.array(model.score(batch.column("text").to_pylist(), words), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    bare = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    scored = bare.mapInArrow(task, "doc_id long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The contract's rows."""
    return scores(docs, fit(docs, labels, **options))
