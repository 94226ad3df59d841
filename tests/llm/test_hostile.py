"""One table of hostile rows over every operator and the pipeline, and statistics held against brute force."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marlstone.llm import bpe_codec, common, exact_dedup, ngram_join, packing, pii, quality_rules, queries, resampling, token_counts, training_order

CLASH = ["_own", "_id", "_sha", "_words", "_text", "_digest", "_term", "_email", "kept", "score", "n_words", "salt", "chunk", "rank", "component_id", "_gone", "key", "_", "_terms", "_quality", "none", "c0", "before", "after"]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def hostile(spark, tmp_path_factory):
    """Null, empty, blank, very long, repeated and tied rows, null ids, and columns named like the operators' own."""
    long = prose(1, 150_000) + " x@y.example " + "@" * 3000 + "1." * 3000 + "+1" * 3000 + "\n" * 500
    mail = "quorvex writes to ann@mail.example.org often " + prose(2, 80)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, mail), (None, mail), (4, mail), (5, long), (6, long), (6, long), (7, prose(3, 90)), (7, prose(4, 90))]
    rows += [(100 + i, prose(5, 120) + f" end{i % 3}") for i in range(12)] + [(200, "\x00\x1c é🙂 " * 30), (2**62, prose(6, 70))]
    folder = tmp_path_factory.mktemp("hostile")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASH:
        docs = docs.withColumn(name, F.concat(F.lit("own "), F.length("text").cast("string")))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (7, 1, 0), (100, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def per_document(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    return docs, {
        "op1": lambda d: bpe_codec.round_trip_digests(d),
        "op3": lambda d: resampling.resample(d, labels),
        "op4": lambda d: exact_dedup.exact_groups(d),
        "op5": lambda d: token_counts.count_tokens(d, "v", lambda texts: [len(t) for t in texts]),
        "op6": lambda d: quality_rules.quality_verdicts(d, labels, out=common.free_name(d, "_quality")),
        "op8": lambda d: pii.report(pii.find_personal_data(d)),
        "op9": lambda d: ngram_join.near_duplicates(d),
    }


@pytest.mark.parametrize("op", ["op1", "op3", "op4", "op5", "op6", "op8", "op9"])
def test_a_row_for_each_hostile_row_and_none_for_none(spark, hostile, op):
    docs, made = per_document(spark, hostile)
    rows = made[op](docs).collect()
    assert len(rows) == docs.count()
    ids = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert collections.Counter(r.doc_id for r in rows) == ids
    assert made[op](docs.limit(0)).count() == 0


def test_packing_and_order_of_hostile_rows(spark, hostile, tmp_path):
    docs = spark.read.parquet(f"{hostile}/documents.parquet")
    pieces = packing.pack_documents(docs).collect()
    encoder = packing.word_encoder()
    total = sum(len(encoder.encode(r.text or "")) for r in docs.select("text").collect())
    assert sum(r.length for r in pieces) == total
    rows = training_order.materialise(docs, path=f"file://{tmp_path}/s", length=64, rows=64).collect()
    encode = training_order.encoder().encode_ordinary
    assert sum(r.n_tokens for r in rows) == sum(len(encode(r.text or "")) + 1 for r in docs.select("text").collect())
    assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_stages_keep_the_callers_columns(spark, hostile):
    docs = spark.read.parquet(f"{hostile}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, hostile)
        assert out.columns == docs.columns, name
        rows = out.where("n_words is not null or text is not null").collect()
        if name != "pii":
            assert all(getattr(r, c) == (None if r.text is None else f"own {len(r.text)}") for r in rows for c in CLASH), name


def test_pipeline_by_its_stages(spark, hostile):
    docs = spark.read.parquet(f"{hostile}/documents.parquet")
    rows = corpus_pipeline.run(spark, hostile).collect()
    texts = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert {r.doc_id for r in rows} <= {i for i, _ in texts}
    # short and empty rows go, of copies and near copies one stays, the mail address is gone
    assert not {1, 2, 3} & {r.doc_id for r in rows} and sum(100 <= r.doc_id < 112 for r in {r.doc_id: r for r in rows if r.doc_id}.values()) <= 1
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == packing.CAP or at & (at - 1) == 0


def test_queries_do_not_change_the_session(spark):
    names = "bpe training_order importance_resampling exact_dedup token_counts quality_rules warc_derivatives pii ngram_join packing concurrency toxicity alignment"
    assert queries.QUERIES.keys() == {f"op{n}_{x}" for n, x in enumerate(names.split(), 1)}


# -- statistics by brute force -------------------------------------------------------
def wilson_bits(n_et, n_t):
    z2, p = 1.96**2, min(n_et / n_t, 1)
    low = (p + z2 / (2 * n_t) - math.sqrt(z2 * (p * (1 - p) / n_t + z2 / (4 * n_t**2)))) / (1 + z2 / n_t)
    return -math.log2(low)


def disclosing_by_hand(texts):
    """{term: bits left} over different texts, from the definition."""
    import re

    texts = [t for t in dict.fromkeys(t or "" for t in texts)]
    email = re.compile(pii.PATTERNS["email"].replace(r"\G|", ""))
    is_term, trim = re.compile(r"[^\W\d_][\w-]{2,}\Z"), ".,;:!?()[]\"'"
    term = lambda w: w.lower().strip(trim)
    words = [t.split() for t in texts]
    n_words, n_texts = sum(map(len, words)), len(texts)
    often = collections.Counter(term(w) for ws in words for w in ws)
    wide = collections.Counter(t for ws in words for t in {term(w) for w in ws})
    near, far, e_spans, e_texts = (collections.Counter() for _ in range(4))
    for t in texts:
        marked = email.sub(" \x01 ", t).split()
        found = [m[0].lower() for m in email.finditer(t)]
        at = [i for i, w in enumerate(marked) if w == "\x01"]
        for e, i in zip(found, at, strict=True):
            e_spans[e] += 1
            for x in {term(w) for w in marked[max(0, i - pii.REACH) : i + pii.REACH + 1]}:
                near[e, x] += is_term.match(x) is not None
        for e in set(found):
            e_texts[e] += 1
            for x in {term(w) for w in t.split()}:
                far[e, x] += is_term.match(x) is not None
    out = {}
    for joint, n_e, n_t, w, least in ((near, e_spans, often, n_words, 1), (far, e_texts, wide, n_texts, 2)):
        for (e, x), n in joint.items():
            if n >= least and n_t[x]:
                bits = wilson_bits(n, n_t[x])
                if bits <= min(pii.BITS, pii.SHARE * math.log2(w / n_e[e])) + 1e-9:
                    out[x] = min(out.get(x, 99), bits)
    return out


def test_pii_terms_by_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"word{''.join(rng.choices('abcdefgh', k=3))}" for _ in range(300)]
    texts = []
    for i in range(150):
        ws = rng.choices(vocabulary, k=rng.randint(5, 60))
        for _ in range(rng.choice([0, 0, 1, 2])):
            person = rng.randint(0, 25)
            ws.insert(rng.randint(0, len(ws)), f"p{person}@corp.example")
            if rng.random() < 0.8:
                ws.insert(rng.randint(0, len(ws)), f"Name{'abcdefghijklmnopqrstuvwxyz'[person]},")
        texts += [" ".join(ws)] * rng.choice([1, 1, 1, 4])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find_personal_data(docs).select("doc_id", "_term").collect()
    got = {(s.value.lower(), s.kind) for r in rows for s in r._term}
    want = {(x, "removed" if bits <= pii.REMOVE_BITS else "term") for x, bits in disclosing_by_hand(texts).items()}
    assert got == want and len(want) > 10


def test_pii_planted_terms_are_found(spark):
    """Names planted beside the addresses of real documents: recall over entities of one, two and three texts."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rng, planted, out = random.Random(9), {}, []
    for n, r in enumerate(rows):
        if n % 10 == 0 and len(r.text.split()) > 20:
            who = n // 10
            name, ws = f"qx{who:04d}name", r.text.split(" ")
            at = rng.randint(5, len(ws) - 5)
            ws[at:at] = [name, f"u{who}@plant.example"]
            out.append((r.doc_id, " ".join(ws)))
            planted[name] = r.doc_id
            for extra in range(who % 3):  # a second and a third text of the same person, the name far away
                out.append((10**6 * (extra + 1) + r.doc_id, f"{name} {prose(who * 7 + extra, 60)} u{who}@plant.example"))
        else:
            out.append((r.doc_id, r.text))
    found = pii.find_personal_data(spark.createDataFrame(out, "doc_id long, text string")).select("doc_id", "_term").collect()
    seen = {(r.doc_id, s.value.lower()) for r in found for s in r._term}
    caught = sum((doc, name) in seen for name, doc in planted.items())
    assert len(planted) > 80 and caught >= 0.9 * len(planted)


def test_pii_long_hostile_text_takes_linear_time(spark):
    import time

    def run(n):
        text = " ".join(f"user{i}@host{i % 7}.example name{i}" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.perf_counter()
        row = pii.sanitise(docs).collect()[0]
        assert row.text.count("[EMAIL]") == n
        return time.perf_counter() - began

    run(50)
    small, large = run(2000), run(16_000)
    assert large < 12 * small + 20


def test_log_ratio_scores_by_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["red", "blue", "green", "grey", "black"][: 3 + 2 * (i % 2)], k=60 + i))) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 20, 4)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    buckets = 1 << 12
    raw, target = collections.Counter(), collections.Counter()
    words = lambda t: [*[(w,) for w in t.split()], *zip(t.split(), t.split()[1:])]
    for i, t in rows:
        raw.update(words(t))
        if i % 4 == 0:
            target.update(words(t))
    # buckets of these few grams do not collide (checked): counts by gram are counts by bucket
    from marlstone.llm.ngram_model import grams, labelled_ids

    hashed = docs.select(grams(F.split("text", " "), buckets).alias("g")).collect()
    assert len({b for r in hashed for b in r.g}) == len(raw)
    ratio = {
        g: math.log((target[g] + 1) / (sum(target.values()) + buckets)) - math.log((raw[g] + 1) / (sum(raw.values()) + buckets)) for g in raw
    }
    want = {i: sum(ratio[g] for g in words(t)) for i, t in rows}
    got = {r.doc_id: r for r in resampling.resample(docs, labels, 0.5, buckets=buckets).collect()}
    for i, t in rows:
        assert got[i].n_grams == len(words(t)) and abs(got[i].log_weight - want[i]) < 1e-3
    # the quality rules count the target over half of the trusted rows and smooth it by the raw model
    roles = {r._target_id: r.role for r in labelled_ids(labels, 100).collect()}
    seen = collections.Counter(g for i, t in rows if roles.get(i) == "target" for g in words(t))
    total, every = sum(seen.values()), sum(raw.values()) + buckets
    assert total and set(roles.values()) == {"target", "held"}
    smooth = {g: math.log((seen[g] + total * (raw[g] + 1) / every) / (2 * total)) - math.log((raw[g] + 1) / every) for g in raw}
    means = {i: sum(smooth[g] for g in words(t)) / len(words(t)) for i, t in rows}
    kept = {r.doc_id: r._quality for r in quality_rules.quality_verdicts(docs, labels, buckets=buckets, max_repeat_percent=100).collect()}
    mark = np.percentile([means[i] for i, role in roles.items() if role == "held"], 2)
    for i, t in rows:
        assert abs(kept[i].score - means[i]) < 1e-5
        assert abs(means[i] - mark) < 1e-5 or kept[i].kept == (means[i] > mark)
    # Gumbel top-k: the keys are the weights and a noise of the hash, and the largest are taken
    keys = sorted(((r.gumbel_key, r.doc_id) for r in got.values()), reverse=True)
    assert {i for _, i in keys[:10]} == {r.doc_id for r in got.values() if r.selected}


def test_quality_threshold_and_models_take_every_labelled_row(spark):
    from marlstone.llm.ngram_model import labelled_ids, trusted_ids

    rng = random.Random(9)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    for ids in (labelled_ids(labels), trusted_ids(labels)):
        assert "Limit" not in ids._jdf.queryExecution().optimizedPlan().toString()
    for n, ties in ((1, 1), (2, 1), (5_000, 1), (5_000, 8)):
        rows = [("held", round(rng.gauss(0.1, 0.3) * ties) / ties if ties > 1 else rng.gauss(0.1, 0.3)) for _ in range(n)]
        rows += [("junk", rng.gauss(-0.4, 0.1)) for _ in range(2 * n)] + [("held", None)]
        marks = [np.percentile([s for r, s in rows if r == role and s is not None], p) for role, p in (("held", 2), ("junk", 98))]
        got = quality_rules._found_threshold(spark.createDataFrame(rows, "role string, score double"), 0.02)
        assert abs(got - sum(marks) / 2) < 1e-9
    assert quality_rules._found_threshold(spark.createDataFrame([], "role string, score double"), 0.02) == quality_rules.THRESHOLD


def test_exact_groups_spread_one_text_over_salts(spark, tmp_path):
    """A text on a third of all rows, with null and repeated ids, is dealt over many keys."""
    rows = [(None if i % 2 else 5, "the same text") for i in range(3000)] + [(i, f"own {i}") for i in range(6000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(24).write.parquet(f"{tmp_path}/d")
    docs = spark.read.option("maxPartitionBytes", 1).parquet(f"{tmp_path}/d")
    prepared = exact_dedup._prepared(docs.repartition(24), 64, 256)
    salts = prepared.where("norm = 'thesametext'").groupBy("salt").count().collect()
    assert len(salts) > 10 and max(r["count"] for r in salts) < 0.3 * 3000
    got = exact_dedup.exact_groups(docs).where("group_size = 3000").collect()
    assert len(got) == 3000 and {r.keep_id for r in got} == {5} and sum(r.kept for r in got) == 1


def test_ngram_join_salts_hot_shingles(spark, monkeypatch):
    """Hot keys dealt over salts give the same components."""
    rng = random.Random(2)
    base = prose(7, 60).split()
    rows = []
    for i in range(90):
        ws = list(base)
        ws[rng.randrange(len(ws))] = f"n{i}"
        rows.append((i, " ".join(ws)))
    rows += [(100 + i, prose(50 + i, 40)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    monkeypatch.setattr(ngram_join, "HOT", 8)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert got == want and len({want[i] for i in range(90)}) == 1


def test_whole_runs_never_cut_a_key():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    keys = np.sort(rng.integers(0, 40, 500))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 17]), pa.array(range(i, min(500, i + 17)))], ["key", "n"]) for i in range(0, 500, 17)]
    out = list(ngram_join._whole_runs(iter(batches), least=30))
    assert [x for t in out for x in t.column("n").to_pylist()] == list(range(500))
    runs = [set(t.column("key").to_pylist()) for t in out]
    assert len(runs) > 3 and all(not a & b for a, b in zip(runs, runs[1:]))
