"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A piece of text is halved down to leaves of a few bytes, each leaf is merged directly, and
neighbours are joined: the tokens next to the seam are re-encoded in a window that doubles
on a side until the pair of tokens at that side's edge is *stable*, that is, encoding the
two tokens' bytes alone gives the two tokens again.

Why that is enough: take a sequence whose neighbouring pairs are all stable, and suppose
that merging the whole text gave something else.  Look at the first merge that crosses a
boundary between two of its tokens.  Until then each token was merged from its own bytes
only, in the order in which its own bytes merge alone, so encoding these two tokens alone
would make the same crossing merge: the pair would not be stable.  Inside the window the
pairs are stable since the window was encoded as a whole, at its edges by the test, and
elsewhere by induction.  A window that reaches both ends is exact in any case.

Decoding concatenates bytes up the same tree.

Pieces of at most ``LEAF_BYTES`` bytes are leaves and merged at once, which by the above gives
the same tokens; most words are, and the tree works on what is longer.

Defined results: null text counts as empty and gives no ids and empty bytes; rows with a null
doc_id, repeated rows and ties are treated like others; a text of any length is encoded
whole, and a piece of any length in n log n; an empty table gives no row; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import small_batches

LEAF_BYTES = 16
CACHE_ENTRIES = 300_000
_NO_RANK = 1 << 62
_BEFORE_SPACE = re.compile(r"\s ")


class Codec:
    def __init__(self, rank_path: str, pattern: str, leaf_bytes: int = LEAF_BYTES) -> None:
        with open(rank_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.leaf_bytes = leaf_bytes
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.name_of = {rank: str(rank) for rank in self.bytes_of}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.chunks = _Chunks(self)

    # -- merging bytes ---------------------------------------------------------------
    def merge(self, piece: bytes) -> list[bytes]:
        """The lowest rank first, the leftmost of equals: the definition, without halving."""
        if len(piece) > 96:
            return self._merge_long(piece)
        if len(piece) < 2:
            return [piece]
        ranks = self.ranks
        parts = [piece[i : i + 1] for i in range(len(piece))]
        scores = [ranks.get(piece[i : i + 2], _NO_RANK) for i in range(len(piece) - 1)]
        while scores:
            best = min(scores)
            if best == _NO_RANK:
                break
            i = scores.index(best)
            token = parts[i] + parts[i + 1]
            parts[i : i + 2] = [token]
            del scores[i]
            if i < len(scores):
                scores[i] = ranks.get(token + parts[i + 1], _NO_RANK)
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + token, _NO_RANK)
        return parts

    def _merge_long(self, piece: bytes) -> list[bytes]:
        """The same with a heap of candidate pairs and linked tokens."""
        n = len(piece)
        end = list(range(1, n + 1))  # of the token that starts here; 0: no token starts here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := self.ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := self.ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or end[j] != k:
                continue
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(piece[i : end[i]])
            i = end[i]
        return out

    # -- the tree --------------------------------------------------------------------
    def stable(self, left: bytes, right: bytes) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            found = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return found

    def join(self, a: list[bytes], b: list[bytes]) -> list[bytes]:
        """The tokens of the concatenated text of two encoded texts."""
        if not a or not b:
            return a + b
        i = j = 1
        while True:
            window = self.merge(b"".join(a[len(a) - i :] + b[:j]))
            left_ok = i == len(a) or self.stable(a[len(a) - i - 1], window[0])
            right_ok = j == len(b) or self.stable(window[-1], b[j])
            if left_ok and right_ok:
                return a[: len(a) - i] + window + b[j:]
            i = i if left_ok else min(len(a), 2 * i)
            j = j if right_ok else min(len(b), 2 * j)

    def tree(self, piece: bytes) -> list[bytes]:
        if len(piece) <= self.leaf_bytes:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one match of the pattern; a piece that is itself a token is that token."""
        found = self.pieces.get(piece)
        if found is None:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            found = (whole,) if whole is not None else tuple(map(self.ranks.__getitem__, self.tree(raw)))
            if len(self.pieces) >= CACHE_ENTRIES:
                self.pieces.clear()
            if len(piece) <= 64:
                self.pieces[piece] = found
        return found

    # -- texts -----------------------------------------------------------------------
    def encode(self, text: str) -> list[int]:
        """Ids of a text, without special tokens.

        Where no white space stands before a space, a match never crosses a space other
        than at its start, so the parts between spaces can be looked up one by one.
        """
        if not text:
            return []
        if _BEFORE_SPACE.search(text):
            return list(chain.from_iterable(map(self.encode_piece, self.pattern.findall(text))))
        first, *rest = text.split(" ")
        ids = list(chain.from_iterable(map(self.encode_piece, self.pattern.findall(first))))
        ids.extend(chain.from_iterable(map(self.chunks.__getitem__, rest)))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class _Chunks(dict):
    """Ids of a space and what follows up to the next one; emptied when full."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        codec = self.codec
        ids = tuple(chain.from_iterable(map(codec.encode_piece, codec.pattern.findall(" " + chunk))))
        if len(chunk) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = ids
        return ids


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def codec(rank_path: str | None = None, pattern: str | None = None) -> Codec:
    """One codec for each worker process, kept over tasks with its bounded caches."""
    import public_tokenizers

    return Codec(rank_path or rank_file(), pattern or public_tokenizers.PATTERN)


def encode_documents(docs: DataFrame, rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and the whole text's ids (array<int>).  Null text has no ids."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for batch in batches:
            ids = [own.encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode_documents(encoded: DataFrame, rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and the bytes of rows of :func:`encode_documents`; null ids decode to null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for batch in batches:
            data = [None if ids is None else own.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip_digests(docs: DataFrame, rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass.

    The digests are made where the ids are, so that no ids travel.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        names = own.name_of.__getitem__
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(",".join(map(names, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(text_digests)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, schema)
