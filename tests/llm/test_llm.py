import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import (
    bpe_codec, common, exact_dedup, ngram_join, ngram_model, packing, pii, quality_rules, resampling, token_counts, training_order, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i % 977}x" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n "), (None, "null id"), (4, "null id"), (5, long), (6, long), (6, long), (7, "é🙂 ß " * 40)]
    return docs_of(spark, rows).withColumn("score", F.lit("clash")).withColumn("kept", F.lit("clash"))


def test_bpe_equals_tiktoken_and_round_trips(spark, odd):
    import public_tokenizers
    import tiktoken

    small = bpe_codec.Codec(bpe_codec.rank_file(), public_tokenizers.PATTERN, leaf_bytes=2)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=small.ranks, special_tokens={})
    rng = random.Random(3)
    letters = ["a", "b", " ", "\n", "'s", "é", "1", "!", "🙂", "the", "日"]
    texts = ["a" * 700, "ab" * 500, " " * 301, "=-" * 99, "\n x \n\n y", "aab" * 300]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(400)]
    for text in texts:
        ids = small.encode(text)
        assert ids == library.encode_ordinary(text) and small.decode(ids) == text.encode()
    usual = bpe_codec.Codec(bpe_codec.rank_file(), public_tokenizers.PATTERN)
    for text in ["ab" * 5000, "é" * 3000, "".join(rng.choices("abcdefghij", k=20_000)), "日本" * 900, "-=" * 2000]:
        assert usual.encode(text) == library.encode_ordinary(text)
    for r, t in zip(bpe_codec.round_trip_digests(odd).collect(), [r.text or "" for r in odd.collect()]):
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bpe_codec.decode_documents(bpe_codec.encode_documents(odd)).count() == odd.count()
    assert bpe_codec.round_trip_digests(odd.limit(0)).count() == 0


def test_exact_groups_by_brute_force(spark, odd):
    for bits in (256, 4):  # 4: digests collide, contents still decide
        rows = [(i, random.Random(i % 40).choice(["a b", "ab", "a\tb ", "c", "", "d e f"]) + "x" * (i % 7)) for i in range(200)]
        got = exact_dedup.exact_groups(docs_of(spark, rows), salts=4, digest_bits=bits).collect()
        groups = {}
        for i, t in rows:
            groups.setdefault("".join(t.split()), []).append((-len(t), i))
        for r in got:
            own = groups["".join(dict(rows)[r.doc_id].split())]
            assert (r.keep_id, r.group_size, r.kept) == (min(own)[1], len(own), min(own)[1] == r.doc_id)
    got = exact_dedup.exact_groups(odd).collect()
    assert len(got) == 9 and sum(r.kept for r in got) == 4
    assert exact_dedup.drop_copies(odd).count() == 4
    assert exact_dedup.exact_groups(odd.limit(0)).count() == 0


def repeats(words):
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({p for at in windows.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)})


def test_quality_rules(spark, odd):
    rng = random.Random(5)
    good = [f"g{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(good, k=rng.randint(40, 300)))) for i in range(60)]
    rows += [(100 + i, " ".join(f"j{rng.randint(0, 9)}" for _ in range(90)) + " ***\nx\nx\n") for i in range(30)]
    marks = [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(9)] + [(3, 1, 0), (31, 1, 1), (None, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r._quality for r in quality_rules.quality_verdicts(docs_of(spark, rows), labels, buckets=256).collect()}
    for i, text in rows:
        words = text.split()
        assert (got[i].n_words, got[i].n_repeat_words) == (len(words), repeats(words))
        assert got[i].base_failed == (len(words) < 50 or 2 * repeats(words) > len(words))
        assert got[i].n_symbols == text.count("*") and got[i].n_dup_lines == (i >= 100)
    # most of what no label names is kept, junk never
    assert sum(got[i].kept or got[i].base_failed for i in range(60)) > 55 and not any(got[i].kept for i, _ in rows[60:])
    plain = quality_rules.quality_verdicts(odd, labels.limit(0)).collect()
    assert all(r._quality.kept == (not r._quality.base_failed) and r.score == r.kept == "clash" for r in plain)


@pytest.mark.parametrize("size, clean", [("sf0.001", 0.85), ("sf0.01", 0.88), ("sf0.1", 0.99)])
def test_quality_verdicts_on_labelled_rows_left_out(spark, size, clean):
    """Labels of every third id are kept from the operator: how many of their clean rows stay, and of their junk."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{name}.parquet") for name in ("documents", "labels"))
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    got = quality_rules.quality_verdicts(docs, labels.where(~out)).select("doc_id", "_quality.*").where("not base_failed")
    rates = got.join(labels.where(out).where("toxic = 0"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate"))
    rates = {r.quality: r.rate for r in rates.collect()}
    assert rates[1] >= clean and rates.get(0, 0) <= 0.1


def jaccard_components(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_ngram_join_by_brute_force(spark, odd, monkeypatch):
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(20)]
    rows = []
    for i in range(120):
        base = random.Random(i % 25)
        words = [f"v{base.randint(0, 300)}" for _ in range(base.randint(6, 80))]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 5)}"
        rows.append((i, " ".join(passage * (i % 3 == 0) + words)))
    rows += [(200, "one two"), (201, "ONE two"), (202, ""), (203, None), (204, "a b c d e")]
    want = jaccard_components(rows)
    for large in (2048, 2):
        monkeypatch.setattr(ngram_join, "LARGE", large)
        monkeypatch.setattr(ngram_join, "BLOCK", 2 if large == 2 else 512)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs_of(spark, rows)).collect()}
        assert got == want
    assert ngram_join.near_duplicates(odd).count() == odd.count()
    assert ngram_join.drop_near_copies(odd).columns == odd.columns
    assert ngram_join.near_duplicates(odd.limit(0)).count() == 0


def test_bitmap_bounds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x, y = (np.unique(rng.integers(0, 500, 200).astype(np.uint64)) for _ in range(2))
        assert np.bitwise_count(ngram_join.bitmap(x) ^ ngram_join.bitmap(y)).sum() <= len(np.setxor1d(x, y))


def test_pii(spark, odd):
    texts = ["a@b.c_d@e.f x@y@z.com", "1.2.3.4.5 256.1.1.1", "4111 1111 1111 1111, 4111-1111-1111-1112", "+1 (555) 123-4567 +123", "é🙂 a@b.co é"]
    found = pii.report(pii.find_personal_data(docs_of(spark, enumerate(texts)))).orderBy("doc_id").collect()
    assert [r.spans for r in found] == ["email:0:5,email:5:11,email:14:21", "ip:0:7", "card:0:19", "phone:0:17", "email:3:9"]
    assert found[0].base_sha256 == hashlib.sha256(found[0].spans.encode()).hexdigest()
    told = [(i, f"zorblax {w} bob@corp.io {w}ly") for i, w in enumerate("red blue green grey".split())]
    clean = pii.sanitise(docs_of(spark, told + [(50 + i, "common words of many kinds " * 400) for i in range(9)]))
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert all("zorblax" not in texts[i] and "[EMAIL]" in texts[i] for i, _ in told) and texts[50].startswith("common words")
    assert pii.sanitise(odd).columns == odd.columns and pii.sanitise(odd.limit(0)).count() == 0


TOLD = [f"zorblax {w} bob@corp.io {w}ly" for w in "red blue green grey".split()]
FILLER = "common words of many kinds " * 400


def cleaned(spark, texts):
    rows = pii.sanitise(docs_of(spark, enumerate(texts))).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_pii_copies_tell_nothing_new(spark):
    once = cleaned(spark, [*TOLD, FILLER])
    assert not any("zorblax" in t for t in once) and once[4] == FILLER
    assert cleaned(spark, [*TOLD * 10, FILLER]) == once[:4] * 10 + [FILLER]


def test_pii_terms_in_documents_without_the_entity(spark):
    *_, filler, alone, near, null = cleaned(spark, [*TOLD, FILLER, "only Zorblax, here", "zorblaxes stay", None])
    assert (filler, alone, near, null) == (FILLER, "only [TERM], here", "zorblaxes stay", None)


def test_pii_terms_far_from_the_entity(spark):
    far = [f"quibbex {' '.join(f'pad{i}of{k}' for k in range(60))} may@corp.io" for i in range(2)]
    lone = "hapaxword " + "pad " * 60 + "eve@corp.io"
    others = [f"plain text number{i}" for i in range(200)]
    *texts, plain = cleaned(spark, [*far, lone, *others, "quibbex pads"])
    assert not any("quibbex" in t for t in texts[:2]) and all("pad0of5" in t for t in texts[:1])
    assert "hapaxword" in texts[2] and texts[3:] == others and plain == "[TERM] pads"


def check_packed(docs, rows, cap):
    """Every id once, sequences gapless, and full or a power of two."""
    whole, used = {}, {}
    for doc, start, length, crc, total, sequence, offset in rows:
        part = dict(docs)[doc][start : start + length]
        assert length and zlib.crc32(part.astype("<u4").tobytes()) == crc and total == len(dict(docs)[doc])
        whole.setdefault(doc, []).append((start, length))
        used.setdefault(sequence, []).append((offset, length))
    for doc, ids in docs:
        at = 0
        for start, length in sorted(whole.get(doc, [])):
            assert start == at
            at += length
        assert at == len(ids)
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == cap or at & (at - 1) == 0


def test_packing(spark, odd):
    for seed in range(20):
        rng = random.Random(seed)
        sizes = [1, 3, 40, 64, 100, 700] if seed % 2 else range(1, 300)
        docs = [(i, np.arange(rng.choice(sizes), dtype=np.uint32) + i) for i in range(rng.choice([0, 1, 2, 300]))]
        check_packed(docs, list(packing.pack(iter(docs), 0, 64)), 64)
    encoder = packing.word_encoder()
    for text in ["Straße don't I'LL", "ΣΑΣ İstanbul", "日本 ①", "a\x1cb\u0085c", "<|endoftext|>", ""]:
        assert encoder.encode(text).tolist() == [*encoder.by_library(text), 1]
    # a library object of its own, as the contract names it
    import public_tokenizers
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), random.Random(12)
    letters = ["a", "The", " ", " ", "\n", "é", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "1", "ß", "İ", "日", "'s", "!", "\x1c"]
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", *("".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(2000))]
    for text in texts:
        assert encoder.encode(text).tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], repr(text)
    out = packing.pack_documents(odd).collect()
    assert sum(r.length for r in out if r.doc_id == 1) == 1 and packing.pack_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 8, 32])
def test_packing_fills_windows_by_its_rule(parts):
    """Ids of rests in windows that the packer closed, of all; and windows open at once."""
    rng = random.Random(parts)
    rests = [min(int(rng.lognormvariate(6, 1.2)) + 1, 20_000) % 2048 for _ in range(10_000)]
    closed, total, most = 0, 0, 0
    for part in range(parts):
        packer = packing.LevelPacker()
        for size in filter(None, rests[part::parts]):
            total += size
            closed += sum(w.fill for w in packer.place("x", 0, size))
            most = max(most, packer.opened)
        closed += sum(w.fill for w in packer.finish() if w.fill == packing.CAP)
    assert closed >= 0.95 * total and most <= 4 * packing.CAP // packing.LEVEL


def test_packing_prefers_the_least_sum_of_squares():
    """The move taken is the best of all moves, each tried on the counts."""
    rng = random.Random(4)
    packer = packing.LevelPacker(64, 8)
    for _ in range(500):
        size = rng.randint(1, 63)
        squares = lambda fills: sum(n * n for n in np.bincount([f // 8 for f in fills], minlength=9).tolist())
        fills = [w.fill for group in packer.windows for w in group]
        moves = [squares([*fills, size])]
        for i, fill in enumerate(fills):
            others = fills[:i] + fills[i + 1 :]
            after = [fill + size] if fill + size < 64 else [] if fill + size == 64 else [fill + size - 64]
            moves.append(squares(others + after) + (packing.CUT if fill + size > 64 else 0))
        window, cuts = packer._best(size, True)
        if window is None:
            took = moves[0]
        else:
            at = next(i for i, f in enumerate(fills) if f == window.fill)
            took = moves[1 + at]
        # of one level's windows only the fullest fit and the least cut are looked at: as good as any
        assert took == min(moves) or cuts
        list(packer.place("x", 0, size))


def test_training_order(spark, tmp_path):
    for n in (1, 2, 5, 1000):
        assert sorted(training_order.Feistel(n, "k")(np.arange(n)).tolist()) == list(range(n))
    docs = docs_of(spark, [(i, f"text {i} " * (i % 9)) for i in range(50)] + [(99, None)])
    docs.repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    path = f"file://{tmp_path}/shards"
    rows = training_order.materialise(docs, path=path, length=16, rows=8).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    read = list(training_order.read_slots(path, 0, len(rows), 16, 8))
    for r in rows:  # a reader that has the rows alone finds the sequences
        with open(r.shard_path.removeprefix("file://"), "rb") as shard:
            shard.seek(r.byte_offset)
            data = shard.read(32)
        assert zlib.crc32(data) == r.crc32 and np.frombuffer(data, "<u2").tolist() == read[r.slot].tolist()
    stream = [x for r in sorted(rows, key=lambda r: r.sequence) for x in read[r.slot][: r.n_tokens].tolist()]
    assert stream.count(training_order.END_ID) == 51
    assert [x.tolist() for x in training_order.read_slots(path, 5, 9, 16, 8)] == [x.tolist() for x in read[5:14]]
    for every in (1, 1000):
        again = f"file://{tmp_path}/again{every}"
        made = training_order.materialise(docs, path=again, length=16, rows=8, keep_every=every).drop("shard_path").collect()
        assert sorted(made) == sorted(r[:3] + r[4:] for r in rows)
        assert [x.tolist() for x in training_order.read_slots(again, 0, len(rows), 16, 8)] == [x.tolist() for x in read]
    assert training_order.materialise(docs.limit(0), path=f"file://{tmp_path}/none").count() == 0


def test_resampling(spark):
    rows = [(i, i % 7, i % 3) for i in range(100)] + [(5, 5, 2)] * 3 + [(None, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, key long, tie long")
    for k in (0, 1, 14, 50, 99, 104):
        got = resampling.top_k(df, "key", "tie", k).where("selected").collect()
        want = sorted(((r[1], r[2]) for r in rows), reverse=True)[:k]
        assert sorted(((r.key, r.tie) for r in got), reverse=True) == want
    assert resampling.resample(docs_of(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    docs = docs_of(spark, [(i, ("good words here " if i < 50 else "bad junk there ") * 30) for i in range(100)] + [(None, None)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(25)], "doc_id long, quality int, toxic int")
    got = resampling.resample(docs, labels, 0.5).collect()
    assert sum(r.selected for r in got) == 51 and all(r.selected for r in got if r.doc_id is not None and r.doc_id < 50)


def test_gram_buckets_agree(spark):
    """Counting and scoring hash alike."""
    df = spark.createDataFrame([(True, ["a"]), (False, ["b", "c", "b"]), (False, [])], "trusted boolean, _words array<string>")
    ratios = np.array(ngram_model.log_ratios(df, 4096))
    own = {b for r in df.where("not trusted").select(ngram_model.grams(F.col("_words"), 4096).alias("g")).collect() for b in r.g}
    least = ratios.max() - 0.1  # buckets that only the raw corpus has are well below the others
    assert own == set(np.flatnonzero(ratios < least).tolist()) and len(own) == 4


def test_token_rollup(spark):
    rollup = token_counts.Rollup(spark, common.new_path(spark, "rollup-test"))
    rows = docs_of(spark, [(1, "a b"), (2, None), (3, "c")]).withColumn("source", F.when(F.col("doc_id") < 3, "s"))
    counts = token_counts.count_tokens(rows, "v1", lambda texts: [len(t.split()) for t in texts])
    assert rollup.commit("b1", token_counts.inserts(counts)) and not rollup.commit("b1", token_counts.inserts(counts))
    assert {(r.source, r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == {("s", 2, 2), (None, 1, 1)}
    assert rollup.commit("b2", token_counts.deletes(counts.where("source is null"))) and rollup.compact()
    assert not rollup.commit("b2", token_counts.deletes(counts))
    assert rollup.commit("b3", token_counts.revisions(counts.where("source = 's'"), counts.where("source = 's'").withColumn("n_tokens", F.lit(9).cast("long"))))
    want = [("s", 2, 18)]
    assert [(r.source, r.n_docs, r.n_tokens) for r in rollup.totals().collect()] == want
    # two writers of one batch, and of one base: one wins
    place = f"{rollup.path}/batches/{rollup._place('b4')}.json"
    assert rollup._create(place, {"batch": "b4", "sums": rollup._write(rollup._rows([]))})
    assert not rollup.commit("b4", token_counts.inserts(counts))
    state = rollup._state()
    assert rollup.compact() and not rollup._create(f"{rollup.path}/base/{state[2] + 1:012d}.json", {})
    rollup.clean_up()
    assert [(r.source, r.n_docs, r.n_tokens) for r in rollup.totals().collect()] == want and len(rollup._state()[0]) == 1


def test_token_counts_query_by_brute_force(spark, tmp_path):
    from marlstone.llm import queries

    texts = [(i, ["one two", "", None, "tokenization of words, 12345!"][i % 4]) for i in range(40)]
    docs_of(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 3 > 0, "x")).write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for version, path in (("byte_bpe_50k", None), ("byte_bpe_multi_50k", bpe_codec.rank_file())):
        encode = training_order.encoder(path).encode_ordinary
        for i, t in texts:
            key = ("x" if i % 3 else None, version)
            n, k = want.get(key, (0, 0))
            want[key] = n + 1, k + len(encode(t or ""))
    got = queries.op5_token_counts(spark, str(tmp_path)).collect()
    assert {(r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in got} == want


PAGE = (
    "<html lang='en'><head><title>T &amp; U</title><a href='/head'>h</a></head><!-- <p>no --><p>Hi <b>you</b><script>no</script>"
    "<p>a&lt;b<a href='/l'>k</a><a href='/x&#13;&#10;title: forged'>1 < 2</a>&#99999999999999999999;<br>z"
)


def by_kind(rows, page_id):
    return tuple(next(r for r in rows if r.page_id == page_id and r.warc_type == k) for k in ("metadata", "conversion"))


def test_warc(spark):
    pages = [(1, "http://x", PAGE), (2, None, None), (3, "http://y\r\nX: y", "a<b"), (4, "u", "<p>same"), (4, "u", "<p>same")]
    source = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("record_id", F.lit("clash"))
    responses = warc.page_responses(source)
    rows = warc.derivatives(responses).collect()
    own = {r.page_id: r.record_id for r in responses.collect()}
    meta, text = by_kind(rows, 1)
    assert meta.refers_to == text.refers_to == own[1] and len(rows) == 10
    assert bytes(text.block).decode() == "Hi you\na<bk1 < 2\ufffd\nz" and text.block_digest == warc.digest(bytes(text.block))
    lines = bytes(meta.block).decode().split("\r\n")
    assert [x for x in lines if x.startswith("title:")] == ["title: T & U"] and "lang: en" in lines
    assert [x for x in lines if x.startswith("outlink")] == ["outlink: /l", "outlink: /x title: forged"]
    assert "source-header: Content-Type: text/html; charset=utf-8" in lines
    assert text.payload_digest == warc.digest(PAGE.encode()) and by_kind(rows, 3)[0].target_uri == "http://y X: y"
    assert len({r.record_id for r in rows}) == 10  # repeated pages are records of their own
    assert warc.derivatives(warc.page_responses(source.limit(0))).count() == 0


def test_warc_written_and_read_again(spark, tmp_path):
    payload = "<p>caf\u00e9".encode("latin-1")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\n  more\r\n\r\n" + payload
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://t\r\nWARC-Date: 2020-02-02T00:00:00Z\r\nWARC-Payload-Digest: sha1:GIVEN\r\nContent-Length: {len(http)}\r\n\r\n"
    other = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    data = other + head.encode() + http + b"\r\n\r\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(data)
    import gzip
    import io

    (tmp_path / "in" / "b.warc.gz").write_bytes(gzip.compress(other) + gzip.compress(data[len(other) :]))
    responses = warc.read_responses(spark, f"file://{tmp_path}/in")
    assert [(r.record_id, r.payload_digest, r.date) for r in responses.collect()] == [("<urn:uuid:1>", "sha1:GIVEN", "2020-02-02T00:00:00Z")] * 2
    derived = warc.derivatives(responses.limit(1))
    done = warc.write_files(derived, f"file://{tmp_path}/out").collect()
    assert sum(r.records for r in done) == 2
    read = [
        record
        for path in sorted((tmp_path / "out").glob("*.warc.gz"))
        for record in warc.records(gzip.GzipFile(fileobj=io.BytesIO(path.read_bytes())))
    ]
    assert [h["warc-type"] for h, _ in read] == ["metadata", "conversion"] and {h["warc-refers-to"] for h, _ in read} == {"<urn:uuid:1>"}
    (meta, about), (conversion, text) = read
    assert text.decode() == "caf\u00e9" and conversion["warc-payload-digest"] == "sha1:GIVEN" and warc.digest(text) == conversion["warc-block-digest"]
    assert b"source-header: Set-Cookie: b=2 more\r\n" in about and b"source-header: Set-Cookie: a=1\r\n" in about


@pytest.mark.parametrize(
    "unit", ["<!--", "<script>", "<head>", "<title>", "<a href='", "</script ", "&#9", "<", "<p>x", "<a href=\"x\">", "<!-- -->", "&#0"]
)
def test_warc_hostile_pages_take_linear_time(unit):
    import time

    def run(size):
        page = unit * (size // len(unit))
        began = time.perf_counter()
        warc.Page(page)
        return time.perf_counter() - began

    small, large = run(250_000), run(2_000_000)
    assert large < 24 * small + 1


def test_a_batch_whose_writer_died_is_made_good(spark, tmp_path):
    """The name of the entry was taken, the entry never came: the next attempt commits, once."""
    sums = spark.createDataFrame([("s", "en", "v", 1, 10)], "source string, lang string, tokenizer string, docs long, tokens long")
    changes = sums.toDF(*token_counts.KEYS, "docs", "tokens")
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r", claim_seconds=0.1)
    place = rollup._place("b1")
    (tmp_path / "r" / "batches" / f"{place}.json.claim").write_bytes(b"")
    assert rollup.totals().count() == 0
    assert rollup.commit("b1", changes) and rollup.committed("b1") and not rollup.commit("b1", changes)
    assert rollup.commit("b2", changes)
    assert [(r.n_docs, r.n_tokens) for r in rollup.totals().collect()] == [(2, 20)]
    (tmp_path / "r" / "base" / f"{0:012d}.json.claim").write_bytes(b"")
    assert rollup.compact() and [(r.n_docs, r.n_tokens) for r in rollup.totals().collect()] == [(2, 20)]
