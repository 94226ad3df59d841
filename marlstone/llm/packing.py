"""Sum-of-squares online packing of tokenised documents.

Each input partition packs its own documents, in its own order, so nothing is shuffled and
a repeated task gives the same sequences.  A document's full windows are sequences of
their own.  Its rest goes where it least increases the sum of squares of the counts of
partly filled windows, N(1)^2 + N(2)^2 + ..., by fill level; a level is ``LEVEL`` ids wide,
the counts are one array, and a level holds its windows by fill.  The moves of a rest of s ids are

* into a window that has room for it: N falls by one at its level and grows at the new one,
  or, where that fills the window, only falls;
* cut in two: its first part fills a window of too little room and closes it, the other part
  opens a window, and ``CUT`` is added for the cut;
* into a new window.

Closing a window of a crowded level gains most, so levels cannot fill up: open windows stay
within a few for each level, whatever the number of documents, and no size switches to
another packer.  When the documents end, the emptiest window's pieces are placed anew by the same rule, but
without new windows, until one window is left.  Only that last one is no full window: it is
cut into powers of two.  So no sequence needs padding at all.

Defined results: null text counts as empty; an empty document is the end id alone; an empty
table gives no rows; rows with a null doc_id and rows that share one are documents like
others; a text of any length is one document; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import functools
import json
import math
import re
import unicodedata
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import small_batches

CAP = 2048
END_ID = 1
#: Ids in one fill level, and what a cut costs in the sum of squares.
LEVEL = 64
CUT = 1
CACHE_ENTRIES = 400_000
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Window:
    """A partly filled window: pieces (item, start, length) end to end."""

    __slots__ = ("fill", "pieces")

    def __init__(self) -> None:
        self.fill = 0
        self.pieces: list[tuple] = []

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += piece[2]


class LevelPacker:
    """Places pieces one by one; gives back the windows that were filled."""

    def __init__(self, cap: int = CAP, level: int = LEVEL) -> None:
        self.cap = cap
        self.level = min(level, cap)
        self.count = [0] * (cap // self.level + 1)
        # by level the windows in order of fill
        self.windows: list[list[Window]] = [[] for _ in self.count]
        self.opened = 0

    def _take(self, window: Window) -> None:
        h = window.fill // self.level
        self.windows[h].remove(window)
        self.count[h] -= 1
        self.opened -= 1

    def _keep(self, window: Window) -> None:
        h = window.fill // self.level
        insort(self.windows[h], window, key=_fill)
        self.count[h] += 1
        self.opened += 1

    def _best(self, size: int, new: bool) -> tuple[Window | None, bool]:
        """The window of the best move and whether it cuts; no window: a new one."""
        cap, level, count = self.cap, self.level, self.count
        best = (2 * count[size // level] + 1, 2, 0) if new or not self.opened else (math.inf, 3, 0)
        choice: tuple[Window | None, bool] = (None, False)
        for h, n in enumerate(count):
            if not n:
                continue
            group = self.windows[h]
            at = bisect_right(group, cap - size, key=_fill)
            if at:  # the fullest that has room
                window = group[at - 1]
                after = (window.fill + size) // level
                if window.fill + size == cap:
                    score = 1 - 2 * n
                else:
                    score = 0 if after == h else 2 * (count[after] - n) + 2
                if (score, 0, -window.fill) < best:
                    best, choice = (score, 0, -window.fill), (window, False)
            if at < n:  # the fullest of all: the least is cut off
                window = group[-1]
                left = (size - cap + window.fill) // level
                score = 1 - 2 * n + 2 * (count[left] - (left == h)) + 1 + CUT
                if (score, 1, -window.fill) < best:
                    best, choice = (score, 1, -window.fill), (window, True)
        return choice

    def place(self, item, start: int, length: int, new: bool = True) -> Iterator[Window]:
        """Place ids [start, start + length) of an item, fewer than ``cap``; the windows filled by that."""
        while length:
            window, cuts = self._best(length, new)
            if window is None:
                window = Window()
            else:
                self._take(window)
            part = min(length, self.cap - window.fill)
            window.add((item, start, part))
            start, length = start + part, length - part
            if window.fill == self.cap:
                yield window
            else:
                self._keep(window)

    def finish(self) -> Iterator[Window]:
        """All windows that are still open: filled ones, and at most one that is not, last."""
        while self.opened > 1:
            window = next(group[0] for group in self.windows if group)
            self._take(window)
            for piece in window.pieces:
                yield from self.place(*piece, new=False)
        for group in self.windows:
            yield from group
            group.clear()
        self.count = [0] * len(self.count)
        self.opened = 0


def _fill(window: Window) -> int:
    return window.fill


def pack(documents: Iterator[tuple[int | None, np.ndarray]], first: int, cap: int = CAP) -> Iterator[tuple]:
    """Rows of SCHEMA for (doc_id, ids); sequence ids count up from ``first``."""
    packer = LevelPacker(cap)
    number = first

    def row(doc, ids, start, length, offset):
        part = np.ascontiguousarray(ids[start : start + length], "<u4")
        return doc, start, length, zlib.crc32(part.tobytes()), len(ids), number, offset

    def rows(window: Window) -> Iterator[tuple]:
        nonlocal number
        room, used, left = cap, 0, window.fill
        if left < cap:
            room = 1 << (left.bit_length() - 1)
        for (doc, ids), start, length in window.pieces:
            while length:
                part = min(length, room - used)
                yield row(doc, ids, start, part, used)
                start, length, used, left = start + part, length - part, used + part, left - part
                if used == room:
                    number += 1
                    room, used = 1 << max(left.bit_length() - 1, 0), 0

    for doc, ids in documents:
        whole = len(ids) // cap * cap
        for start in range(0, whole, cap):
            yield row(doc, ids, start, cap, 0)
            number += 1
        for window in packer.place((doc, ids), whole, len(ids) - whole):
            yield from rows(window)
    for window in packer.finish():
        yield from rows(window)


# -- ids -----------------------------------------------------------------------------
#: Outside these, lower case and composition are left to the tokenizers library.
_ODD = re.compile("[^\\x00-\\x1b\\x20-ɏ‐-‧€]")
_ENDS = ".,;:!?"
_SEPARATORS = re.compile("[\\x1c-\\x1f]")
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


class WordEncoder:
    """Ids of a word-end BPE file of the tokenizers library, by parts between white space.

    No match of the file's pattern crosses white space, so parts can be kept in a bounded
    dictionary.  A new part's words go through the same merges in tiktoken, with a line end
    as the word-end mark: no word has one.  Parts with characters whose lower case or
    composition is not plain go to the library itself, as do texts with a special token's name.
    """

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # a special token's name inside a text is that token, as the library has it
        names = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, names)) or r"(?!)")
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        # printable stand-ins for bytes: those printable in Latin-1 are themselves
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        other = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}
        suffix = model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            end = token.endswith(suffix) and len(token) > len(suffix)
            return bytes(byte_of[c] for c in (token[: -len(suffix)] if end else token)) + b"\n" * end

        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ranks: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b]) + b"\n": 256 + b for b in range(256)}
        for left, right in merges:
            ranks.setdefault(raw(left + right), len(ranks))
        self.id_of = [0] * len(ranks)
        for token, number in model["vocab"].items():
            if not (token.startswith("<|") and token.endswith("|>")):
                self.id_of[ranks[raw(token)]] = number
        self.merger = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(_WORDS)
        self.parts = _Parts(self)

    def by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def part(self, part: str) -> tuple[int, ...]:
        plain = part
        if not part.isascii():
            plain = unicodedata.normalize("NFC", part)
            if _ODD.search(plain):
                return tuple(self.by_library(part))
        plain = plain.lower()
        if not plain.isalpha():
            core = plain.rstrip(_ENDS)
            if core != plain and core.isalpha():  # a word and marks: each has its own entry
                return self.parts[core] + self.parts[plain[len(core) :]]
            plain = "\n".join(self.words.findall(plain))
            if not plain:
                return ()
        elif plain != part:
            return self.parts[plain]
        return tuple(map(self.id_of.__getitem__, self.merger.encode_ordinary(plain + "\n")))

    def encode(self, text: str, end_id: int = END_ID) -> np.ndarray:
        # white space to str.split, but not to the library, and what only the library knows
        if _SEPARATORS.search(text) or self.special.search(text):
            ids = self.by_library(text)
        else:
            ids = list(chain.from_iterable(map(self.parts.__getitem__, text.split())))
        ids.append(end_id)
        return np.array(ids, np.uint32)


class _Parts(dict):
    def __init__(self, encoder: WordEncoder) -> None:
        self.encoder = encoder

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.encoder.part(part)
        if len(part) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[part] = ids
        return ids


@functools.lru_cache(maxsize=2)
def word_encoder(path: str | None = None) -> WordEncoder:
    import public_tokenizers

    return WordEncoder(path or public_tokenizers.path("word_bpe_49k.json"))


def pack_documents(docs: DataFrame, path: str | None = None, cap: int = CAP, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A sequence id is the partition's number times 2^32 plus a count, so ids are unique
    without any exchange.  ``docs`` should come from files (or be sorted within its
    partitions), for a repeated task to see the same order.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        first = TaskContext.get().partitionId() << 32
        texts = ((d.as_py(), encoder.encode(t.as_py() or "", end_id)) for b in batches for d, t in zip(*b.columns))
        rows: list[tuple] = []
        for row in pack(texts, first, cap):
            rows.append(row)
            if len(rows) >= 10_000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
