"""Held-out accuracy, what the penalty does to neutral mentions, and odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import toxicity

DATA = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id long, text string, y int, score string, key string", "doc_id long, toxic int, quality int"


def by_hand(text, model):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    counts = Counter(f for w in words for f in [f"={w}", *(f"^{w[:n]}" for n in (3, 4, 5, 6) if len(w) >= n)])
    logit = model.constant + sum(model.weights.get(f, 0) * math.log1p(300 * c / (len(words) + 100)) for f, c in counts.items())
    return 1 / (1 + math.exp(-max(-500, min(500, logit))))


def test_held_out_rows_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.scores(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3)
        assert r.score == pytest.approx(by_hand(texts[i], model), abs=1e-12)
    told = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    toxic, clean = [p for p, y in told if y], [p for p, y in told if not y]
    assert np.mean(toxic) > 0.7 and np.mean(clean) < 0.02
    again = toxicity.fit(docs.repartition(7), labels)
    assert again.weights == model.weights and again.constant == model.constant


def biased(n=400, seed=2):
    """Toxic rows that often name one group, clean rows that rarely name any."""
    rng, rows = random.Random(seed), []
    filler = [f"{a}{b}" for a in ("ka", "lo", "mi", "ten", "su") for b in ("ra", "pel", "don", "vi", "sum")]
    for i in range(n):
        y = int(i % 4 == 0)
        words = rng.choices(filler, k=30)
        if y and rng.random() < 0.6:  # the rest is toxic in a way that no feature shows
            words[rng.randrange(30)] = rng.choice(["vermin", "scumbag", "filthy", "parasites"])
        if rng.random() < (0.8 if y else 0.05):
            words.insert(rng.randrange(30), "muslims")
        rows.append((i, " ".join(words) + ".", y))
    return rows, filler


def test_the_penalty_spares_neutral_mentions(spark):
    rows, filler = biased(2000)
    docs = spark.createDataFrame([(i, t, 9, "own", "own") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], LABELS)
    rng = random.Random(4)
    neutral = [" ".join([*rng.choices(filler, k=15), term, *rng.choices(filler, k=15)]) for term in ("muslims", "christians", "jews") for _ in range(40)]
    bad = [" ".join([*rng.choices(filler, k=15), "vermin", *rng.choices(filler, k=15)]) for _ in range(40)]
    free, held = (toxicity.fit(docs, labels, penalty=p) for p in (0.0, 300.0))
    of = lambda model, texts: np.array(model.score(texts))
    assert (of(free, neutral[:40]) >= 0.3).mean() > 0.5 and (of(held, neutral) >= 0.3).mean() < 0.05
    assert (of(held, bad) >= 0.3).mean() > 0.95
    gap = lambda model: abs(of(model, neutral[:40]).mean() - of(model, neutral[40:]).mean())
    assert gap(held) < gap(free) / 4


def test_swapping():
    before, after = toxicity.swapped("Nothing here. The Women met Muslims! No.")
    assert before == " the women met muslims" and after.startswith(" the men met ") and "muslims" not in after
    assert after.split()[-1] in toxicity.IDENTITY_TERMS[4] and toxicity.swapped("plain text") is None and toxicity.swapped(None) is None
    assert toxicity.swapped(" The Women met Muslims!")[1] == after


def test_odd_rows(spark):
    rows, _ = biased(120)
    long = " ".join(f"word{i % 9999}" for i in range(200_000))
    odd = [(None, "vermin vermin"), (7000, None), (8000, ""), (8001, "\x00 1 2 3"), (900, long), (900, long), (5, rows[5][1])]
    docs = spark.createDataFrame([(i, t, 9, "own", "own") for i, t in [*((i, t) for i, t, _ in rows), *odd]], DOCS)
    labels = spark.createDataFrame([*((i, y, 1) for i, _, y in rows), (1, 1, 0), (3, None, 1), (None, 1, 1), (11, 7, 1)], LABELS)
    got = toxicity.toxicity(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    assert all(0 <= r.score <= 1 for r in got) and all(not r.held_out for r in got if r.doc_id is None)
    empty = {r.score for r in got if r.doc_id in (8000, 8001)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {1 / (1 + math.exp(500))}
    one = toxicity.toxicity(docs, labels.where("toxic = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.9


def test_the_sample_is_bounded(spark):
    rows, _ = biased(4000)
    docs = spark.createDataFrame([(i, t, 9, "own", "own") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], LABELS)
    n = toxicity.training_rows(docs, labels, 500).count()
    assert 400 < n < 600
    assert toxicity.training_rows(docs, labels).count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _, _ in rows)
