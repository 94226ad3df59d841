"""Alignments against the libraries on whole texts, and counts over the corpus by hand."""

import collections
import hashlib
import random

import pytest

from marlstone.llm import alignment


def whole(text, a_library, b_library):
    """(n_a, n_b, groups, links) of one text from the definition, or None."""
    a = [(i, a_library.decoded[i]) for i in a_library.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in b_library.encode(text):
        piece = b_library.id_to_piece(i)
        byte = len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")
        b.append((i, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
    target = (" " + text).encode()
    if not text or b"".join(t for _, t in a) != target or b"".join(t for _, t in b) != target:
        return None
    sides, ends = [], []
    for side in (a, b):
        at, own = 0, []
        for i, token in side:
            at += len(token)
            own.append((at, i))
        sides.append(own)
        ends.append({e for e, _ in own})
    common = sorted(ends[0] & ends[1])
    groups, last = [], 0
    for end in common:
        groups.append("|".join(",".join(str(i) for e, i in own if last < e <= end) for own in sides))
        last = end
    links = [(i, j) for end in common for e, i in sides[0] if e == end for f, j in sides[1] if f == end]
    return len(a), len(b), groups, links


class Library:
    def __init__(self, path):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        self.encode = self.own.encode
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        table = {chr(c): c for c in letters} | {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in letters)}
        self.decoded = {i: bytes(table[c] for c in token) for token, i in self.own.get_vocab(with_added_tokens=False).items()}


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece

    return Library(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def texts():
    rng = random.Random(8)
    letters = ["the", "of", " ", " ", " ", "  ", "\n", "\t", "'s", "é", "ß", "1", "23", "!", "🙂", "日本", "▁", " ", "<s>", "<|endoftext|>", "<0x41>", "\x00", "\x1c", "é", "　", "\r\n", "hwonand"]
    made = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(250)]
    made += ["".join(rng.choices(letters[:15], k=rng.randint(1, 60))) for _ in range(250)]
    return [None, "", " ", "a", "▁", "x" * 3000, " " * 400, "ab " * 2000, "\n" * 70 + " x", *made]


def test_texts_as_the_libraries(libraries):
    own = alignment.Aligner(*alignment.default_files())
    with_tokens = 0
    for text in texts() * 2:  # the second time from what is kept
        want, got = whole(text or "", *libraries), own.align(text)
        assert (want is None) == (got is None), repr(text)
        if want:
            with_tokens += 1
            assert got[0] == ";".join(want[2]) and got[2:] == want[:2]
            assert [(p & 0xFFFFFFFF, p >> 32) for p in memoryview(got[1]).cast("q")] == want[3]
    assert with_tokens > 500


def test_what_is_kept_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_STRETCHES", 10)
    own = alignment.Aligner(*alignment.default_files())
    text = " ".join(f"word{i % 40}" for i in range(200))
    once = own.align(text)
    assert len(own) <= 10 and once == own.found(text)


def test_counts_over_the_corpus_by_hand(spark, libraries):
    rows = list(enumerate(texts()))
    rows += [(None, "the ofthe"), (None, "the ofthe"), (3, "a"), *((1000 + i, "the the the of") for i in range(400))]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, pairs string, row int, n int").repartition(5)
    cache = {t: whole(t or "", *libraries) for _, t in rows}
    linked = collections.Counter(link for _, t in rows if cache[t] for link in cache[t][3])
    best = {}
    for (_, j), n in linked.items():
        best[j] = max(n, best.get(j, 0))
    want = []
    for i, t in rows:
        if not cache[t]:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = cache[t]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        want.append((i, n_a, n_b, len(groups), len(links), sum(linked[x] == best[x[1]] for x in links), sum(linked[x] for x in links), sha))
    got = [tuple(r) for r in alignment.linked_documents(docs).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert alignment.linked_documents(docs.limit(0)).collect() == []
