"""Alignment of two tokenizers' tokens, and how often their ids are linked over the corpus.

Side A is a byte-level BPE, side B a piece model with byte fallback that puts a space before the
text; both encode the text with one space before it.  Byte offsets at which a token of each
side ends cut a document into groups, and the two tokens that end there are linked.

Tasks encode and align in one pass and write a document's *postings*: each linked pair of ids
with its multiplicity.  Then, by tables only:

* postings are summed by pair in their own task first, then by a shuffle; a B id's largest
  count is taken over its pairs, of which there are at most as many as A has ids;
* postings and counts meet as two sorted, spillable streams shuffled by side ids (B's, and A's
  too, as one B id may hold a third of all postings): a sort-merge join, whose hot pairs adaptive
  execution splits over tasks;
* each posting gives its document a contribution, and contributions are summed by document.

Words recur, so a worker keeps what it found for each stretch between two single spaces.  That is
exact: both tokenizers put a boundary before a space that follows what is no white space, A's
pattern does not look behind such a boundary, and no piece of B goes on over one (``Aligner``
refuses a model with such a piece).  Where a stretch's tokens do not give its bytes back, the whole
text is encoded at once and decides.

Defined results: texts that are null, empty or not given back by both sides' tokens have zeros and an
empty ``groups_sha256``; rows with a null doc_id and repeated rows are documents of their own; a
text of any length is aligned whole; of equally frequent A ids of a B id each is a best; an
empty table gives no row; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Tidy, cut

#: Stretches that a worker keeps, and documents of an Arrow batch that it gives back.
KEPT_STRETCHES = 400_000
BATCH_DOCUMENTS = 256

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_OTHER_WHITE = re.compile(r"[^\S \n]")
_SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")
_CHANGED = re.compile(r"[^▁]▁")

_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<struct<pair:long,n:int>>"


class _Misfit(Exception):
    """Tokens that do not give their text back."""


def _stretches(text: str) -> list[str]:
    """The parts of a text between single spaces that have no other white space beside them."""
    if text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or _OTHER_WHITE.search(text):
        return _BETWEEN.split(text)
    return text.split(" ")


class Aligner(dict):
    """What is known of a stretch of text, by the stretch without its first space:
    (groups as text, pairs as packed longs, number of A tokens, number of B tokens)."""

    def __init__(self, byte_ranks: str, byte_json: str, piece_model: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        super().__init__()
        self._older: dict = {}
        with open(byte_ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_a = {rank: token for token, rank in ranks.items()}
        self._a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._json = byte_json
        self._b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any(map(_CHANGED.search, pieces)):
            raise ValueError("a piece of this model goes on over a space")
        self.bytes_b = [bytes.fromhex(m[1]) if (m := _BYTE.match(piece)) else piece.replace(_SPACE, " ").encode() for piece in pieces]
        self.size_a, self.size_b = ({i: len(t) for i, t in tokens} for tokens in (self.bytes_a.items(), enumerate(self.bytes_b)))
        self.name_a, self.name_b = ({i: str(i) for i in sizes} for sizes in (self.size_a, self.size_b))

    @functools.cached_property
    def _library(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self._json)
        library.encode_special_tokens = True
        return library

    def _encode_a(self, text: str) -> list[int]:
        try:
            return self._a.encode_ordinary(text)
        except Exception:  # noqa: BLE001  the pattern engine of the rank library gives up on some long runs
            return self._library.encode(text, add_special_tokens=False).ids

    def found(self, stretch: str) -> tuple[str, bytes, int, int]:
        a, b = self._encode_a(" " + stretch), self._b.encode(stretch)
        whole = b" " + stretch.encode()
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            raise _Misfit
        size_a, size_b, name_a, name_b = self.size_a, self.size_b, self.name_a, self.name_b
        groups, pairs, own_a, own_b, left = [], array("q"), "", "", iter(b)
        ahead = 0  # bytes by which the A tokens taken so far go beyond the B tokens
        for i in a:
            own_a = f"{own_a},{name_a[i]}" if own_a else name_a[i]
            ahead += size_a[i]
            while ahead > 0:
                j = next(left)
                own_b = f"{own_b},{name_b[j]}" if own_b else name_b[j]
                ahead -= size_b[j]
            if not ahead:
                groups.append(f"{own_a}|{own_b}")
                pairs.append(j << 32 | i)
                own_a = own_b = ""
        return ";".join(groups), pairs.tobytes(), len(a), len(b)

    def __missing__(self, stretch: str) -> tuple[str, bytes, int, int]:
        value = self._older.get(stretch) or self.found(stretch)
        if len(self) >= KEPT_STRETCHES // 2:
            self._older = dict(self)
            self.clear()
        if len(stretch) < 64:
            self[stretch] = value
        return value

    def align(self, text: str) -> tuple[str, bytes, int, int] | None:
        """The whole text's groups, pairs and counts; None where it has no tokens."""
        if not text:
            return None
        try:
            try:
                parts = [self[stretch] for stretch in _stretches(text)]
            except _Misfit:
                parts = [self.found(text)]
        except _Misfit:
            return None
        return ";".join([p[0] for p in parts]), b"".join([p[1] for p in parts]), sum([p[2] for p in parts]), sum([p[3] for p in parts])


@functools.lru_cache(maxsize=1)
def aligner(byte_ranks: str, byte_json: str, piece_model: str) -> Aligner:
    return Aligner(byte_ranks, byte_json, piece_model)


def default_files() -> tuple[str, str, str]:
    """Ranks of side A, the same vocabulary as the library's file, and side B's model."""
    import public_tokenizers

    return tuple(map(public_tokenizers.path, ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model")))


def _aligned_batch(own: Aligner, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    counts, shas, sizes, pairs, numbers = [], [], [0], [], []
    for text in texts:
        found = own.align(text)
        if found is None:
            counts.append((0, 0, 0))
            shas.append("")
            sizes.append(sizes[-1])
            continue
        groups, packed, n_a, n_b = found
        links = np.frombuffer(packed, "<i8")
        different, times = np.unique(links, return_counts=True)
        counts.append((n_a, n_b, len(links)))
        shas.append(hashlib.sha256(groups.encode()).hexdigest())
        sizes.append(sizes[-1] + len(different))
        pairs.append(different)
        numbers.append(times.astype(np.int32))
    flat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0, kind))
    postings = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays([flat(pairs, np.int64), flat(numbers, np.int32)], ["pair", "n"]))
    n_a, n_b, links = (pa.array([c[k] for c in counts], pa.int64()) for k in range(3))
    return pa.RecordBatch.from_arrays([ids, n_a, n_b, links, pa.array(shas, pa.string()), postings], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])


def align_documents(docs: DataFrame, files: tuple[str, str, str] | None = None) -> DataFrame:
    """A row for each document: its counts of tokens and groups, their digest, and its postings
    ``pairs`` (pair: B's id times 2^32 plus A's; n: how often it is linked here)."""
    files = files or default_files()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*files)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_DOCUMENTS):
                part = batch.slice(at, BATCH_DOCUMENTS)
                yield _aligned_batch(own, part.column(0), part.column(1).to_pylist())

    bare = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return bare.mapInArrow(task, _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n_linked, is_best): links of each pair over the corpus, and whether no A id has more with its B id."""
    postings = aligned.select(F.inline("pairs"))
    linked = postings.groupBy("pair").agg(F.sum("n").alias("n_linked"))
    largest = F.max("n_linked").over(Window.partitionBy(F.shiftright("pair", 32)))
    return linked.select("pair", "n_linked", (F.col("n_linked") == largest).alias("is_best"))


def linked_documents(docs: DataFrame, files: tuple[str, str, str] | None = None) -> DataFrame:
    """The contract's rows: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    with Tidy() as tidy:
        aligned = cut(align_documents(docs, files).withColumn("row", F.monotonically_increasing_id()), "aligned")
        counts = cut(pair_counts(aligned), "pair-counts")
        postings = aligned.select("row", F.inline("pairs"))
        met = postings.join(counts.hint("merge"), "pair")
        sums = met.groupBy("row").agg(
            F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("n_linked")).alias("count_sum")
        )
        zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
        out = aligned.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
        out = cut(out, "alignment")
        tidy.keep(out)
    return out
