"""Training-order materialisation: a keyed permutation of sequences into fixed-stride shards.

Each input partition's documents become one stream of ids, an end id after each document,
cut into sequences of ``length`` ids (the last one filled up with end ids).  Sequences are
numbered over all partitions.  A keyed Feistel network over the next even number of bits,
walked until it falls below the number of sequences, maps the number to a global slot; it
is a bijection, so every slot is taken once, without a sort.  Shard s holds the slots
[s * rows, (s + 1) * rows) in order, ``length`` little-endian unsigned 16-bit ids each:
a reader finds slot t at byte (t % rows) * length * 2 of shard t // rows, and resumes
there.

Slots need the number of all sequences, so a first pass tokenises every document.  Of
every ``KEEP_EVERY``-th partition it keeps the sequences in a table; the documents of the
others are tokenised again, which saves that much disk.  Shards are written under another name and then moved, so a repeated task
leaves the same files.  ``docs`` must come from files, for both passes to see the same
partitions; the second pass fails where a partition's number of sequences is not that of the
first, so no sequence can be lost or doubled.  Each row names its shard's path.

Defined results: null text counts as empty, and gives its end id alone; rows with a null
doc_id and repeated rows are documents like others; a text of any length is one document,
encoded whole; an empty table gives no row and no shard; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, new_path, small_batches

LENGTH = 1024
ROWS = 4096
END_ID = 50256
#: Of this many partitions, one's sequences are kept by the first pass: 1 tokenises once, for the most disk.
KEEP_EVERY = 2
SCHEMA = (
    "slot long, sequence long, shard int, shard_path string, byte_offset long, n_tokens int, doc_ids array<long>, first_start long, crc32 long"
)

_MADE = "part int, number long, ids binary, n_tokens int, doc_ids array<long>, first_start long"
_MADE_NAMES = [f.split()[0] for f in _MADE.split(", ")]


def _made_schema() -> pa.Schema:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.int64())
    return pa.schema(list(zip(_MADE_NAMES, kinds, strict=True)))


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """The library's encoding of a rank file, one for each worker process."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("order", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Feistel:
    """A keyed bijection of [0, n)."""

    def __init__(self, n: int, key: str, rounds: int = 6) -> None:
        self.n = n
        self.half = max(1, -(-max(n - 1, 1).bit_length() // 2))
        self.mask = np.uint64((1 << self.half) - 1)
        seeds = [hashlib.sha256(f"{key}:{r}".encode()).digest()[:8] for r in range(rounds)]
        self.keys = [np.uint64(int.from_bytes(s, "little")) for s in seeds]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << np.uint64(self.half)) | right

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = self._once(np.asarray(x, np.uint64))
        while (over := out >= self.n).any():
            out[over] = self._once(out[over])
        return out.astype(np.int64)


def sequences(texts: Iterator[tuple], encode, length: int, end_id: int) -> Iterator[tuple]:
    """(ids uint16, real ids, doc_ids, start of the first document's part) of a stream."""
    held, docs, start = np.empty(0, np.uint16), [], 0
    for doc, text in texts:
        ids = np.fromiter(itertools.chain(encode(text), (end_id,)), np.uint16)
        at = 0
        while at < len(ids):
            if not docs:
                start = at
            part = ids[at : at + length - len(held)]
            held, at = np.concatenate([held, part]), at + len(part)
            docs.append(doc)
            if len(held) == length:
                yield held, length, docs, start
                held, docs = np.empty(0, np.uint16), []
    if docs:
        yield np.concatenate([held, np.full(length - len(held), end_id, np.uint16)]), len(held), docs, start


def materialise(
    docs: DataFrame,
    key: str = "order-1",
    path: str | None = None,
    tokenizer_path: str | None = None,
    length: int = LENGTH,
    rows: int = ROWS,
    keep_every: int = KEEP_EVERY,
) -> DataFrame:
    """Write the shards to ``path`` and return a row of SCHEMA for each sequence."""
    spark = docs.sparkSession
    small_batches(spark)
    path = path or new_path(spark, "shards")
    slim = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")

    def kept(part: int) -> bool:
        return part % keep_every == 0

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sequences of this partition, numbered from 0."""
        encode, part = encoder(tokenizer_path).encode_ordinary, TaskContext.get().partitionId()
        texts = ((d.as_py(), t.as_py() or "") for b in batches for d, t in zip(*b.columns, strict=True))
        number, out = 0, []
        for item in sequences(texts, encode, length, END_ID):
            out.append((part, number, *item))
            number += 1
            if len(out) == 1000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        parts, numbers, ids, sizes, docs, starts = zip(*out, strict=True)
        columns = [
            pa.array(parts, pa.int32()),
            pa.array(numbers, pa.int64()),
            pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary()),
            pa.array(sizes, pa.int32()),
            pa.array(docs, pa.list_(pa.int64())),
            pa.array(starts, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, _MADE_NAMES)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sequences, or one row with the number of sequences only."""
        part = TaskContext.get().partitionId()
        if kept(part):
            yield from made(batches)
            return
        encode = encoder(tokenizer_path).encode_ordinary
        n = sum(len(encode(t.as_py() or "")) + 1 for b in batches for t in b.column(1))
        row = [[part], [-(-n // length)], [None], [0], [None], [0]]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _made_schema(), strict=True)], _MADE_NAMES)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        if kept(part):
            return
        n = 0
        for b in made(batches):
            n += b.num_rows
            yield b
        if n != expected.value.get(part, 0):
            raise RuntimeError(f"partition {part} gave {n} sequences, {expected.value.get(part, 0)} at first: the input must come from files")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = starts.value
        for b in batches:
            base = np.array([first[part] for part in b.column("part").to_pylist()], np.int64)
            numbers = base + b.column("number").to_numpy()
            columns = [pa.array(order(numbers)), pa.array(numbers), *b.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "sequence", *_MADE_NAMES[2:]])

    table = cut(slim.mapInArrow(first_pass, _MADE), "sequences", compression="zstd")
    size = F.when(F.col("ids").isNull(), F.col("number")).otherwise(1)
    # one small row for each partition
    counts = {r.part: r.n for r in table.groupBy("part").agg(F.sum(size).alias("n")).collect()}
    first, total = {}, 0
    for part in sorted(counts):
        first[part] = total
        total += counts[part]
    starts = spark.sparkContext.broadcast(first)
    expected = spark.sparkContext.broadcast(counts)
    order = Feistel(total, key)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        attempt = TaskContext.get().taskAttemptId()
        now, sink = None, None

        def close() -> None:
            if sink is not None:
                sink.close()
                store.move(f"{root}/_{now:08d}-{attempt}", f"{root}/shard-{now:08d}.bin")

        for b in batches:
            slots = b.column("slot").to_numpy()
            crc = []
            for slot, ids in zip(slots, b.column("ids").to_pylist(), strict=True):
                if slot // rows != now:
                    close()
                    store.create_dir(root)
                    now = int(slot // rows)
                    sink = store.open_output_stream(f"{root}/_{now:08d}-{attempt}")
                sink.write(ids)
                crc.append(zlib.crc32(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("slot"),
                    b.column("sequence"),
                    pa.array((slots // rows).astype(np.int32)),
                    pa.array([shard_path(path, int(slot) // rows) for slot in slots], pa.string()),
                    pa.array(slots % rows * length * 2),
                    b.column("n_tokens"),
                    b.column("doc_ids"),
                    b.column("first_start"),
                    pa.array(crc, pa.int64()),
                ],
                [f.split()[0] for f in SCHEMA.split(", ")],
            )
        close()

    # the documents come first, so that their partitions have the numbers of the first pass
    streams = slim.mapInArrow(again, _MADE).unionByName(table.where("ids is not null"))
    placed = streams.mapInArrow(
        place, "slot long, sequence long, ids binary, n_tokens int, doc_ids array<long>, first_start long"
    )
    shards = max(1, -(-total // rows))
    ranged = placed.repartitionById(shards, (F.col("slot") / rows).cast("int"))
    return ranged.sortWithinPartitions("slot").mapInArrow(write, SCHEMA)


def shard_path(path: str, shard: int) -> str:
    return f"{path}/shard-{shard:08d}.bin"


def read_slots(path: str, first: int, count: int, length: int = LENGTH, rows: int = ROWS) -> Iterator[np.ndarray]:
    """Sequences of the slots [first, first + count), read in order from the shards."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    slot = first
    while slot < first + count:
        with store.open_input_file(f"{root}/shard-{slot // rows:08d}.bin") as file:
            file.seek(slot % rows * length * 2)
            for _ in range(min(first + count - slot, rows - slot % rows)):
                yield np.frombuffer(file.read(length * 2), "<u2")
                slot += 1
