"""Text normalisation and character n-grams for similarity."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACE = re.compile(r"\s+")


def normal_text(text: str) -> str:
    """NFKC, case folded, white space runs as one space, trimmed."""
    return _SPACE.sub(" ", unicodedata.normalize("NFKC", text).casefold()).strip()


@F.pandas_udf(T.StringType())
def normalise(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else normal_text(t))


#: Bits of a set's signature.
SIGNATURE_BITS = 4096
_BASE = 0x110001


def gram_codes(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit codes of the character n-grams of the normalised text.

    A text of fewer than n characters is its one gram; empty and null texts have none.  Up to three
    characters a code is the gram itself; longer grams are hashed.
    """
    plain = normal_text(text or "")
    if not plain:
        return np.empty(0, np.uint64)
    points = np.frombuffer(plain.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    width = min(n, len(points))
    codes = np.zeros(len(points) - width + 1, np.uint64)
    for k in range(width):
        codes = codes * np.uint64(_BASE) + points[k : len(points) - width + 1 + k]
        if k >= 3:
            codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return np.unique(codes)


def signature(codes: np.ndarray, bits: int = SIGNATURE_BITS) -> bytes:
    """A bit for each residue, flipped by each code: two differ in no more bits than the sets in elements."""
    mixed = (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits.bit_length() + 1)
    odd = np.bincount(mixed.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def packed(codes: np.ndarray) -> bytes:
    """Sorted codes in about two bytes each: their differences, byte by byte, compressed."""
    apart = np.diff(codes, prepend=np.uint64(0))
    return zlib.compress(apart.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def packed_sets(n: int):
    """Arrow UDF: struct n_grams, packed of a text."""

    @F.pandas_udf("n_grams int, packed binary")
    def sets(texts: pd.Series) -> pd.DataFrame:
        codes = [gram_codes(text, n) for text in texts]
        return pd.DataFrame({"n_grams": [len(c) for c in codes], "packed": [packed(c) for c in codes]})

    return sets


#: A row's bits: one for each of the most frequent grams, and a signature of the others.
COMMON_BITS, OTHER_BITS = 3840, 256


def gram_counts(sets: DataFrame) -> DataFrame:
    """(code, n): in how many of the ``packed`` sets each gram is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [unpacked(data) for data in batch.column(0).to_pylist()]
            if codes:
                kinds, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.record_batch({"code": pa.array(kinds.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    return sets.select("packed").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def placed_sets(common: np.ndarray):
    """Arrow UDF: struct packed, bits of a packed set: what is not ``common`` packed again, and the bits of all."""
    order = np.argsort(common)
    known = common[order]

    @F.pandas_udf("packed binary, bits binary")
    def sets(column: pd.Series) -> pd.DataFrame:
        rows = []
        for data in column:
            codes = unpacked(data)
            place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            found = known[place] == codes
            marks = np.zeros(COMMON_BITS, np.bool_)
            marks[order[place[found]]] = True
            rows.append((packed(codes[~found]), np.packbits(marks).tobytes() + signature(codes[~found], OTHER_BITS)))
        return pd.DataFrame(rows, columns=["packed", "bits"])

    return sets
