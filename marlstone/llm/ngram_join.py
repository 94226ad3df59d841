"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.  Documents link
when 100 * intersection >= 75 * union, that is, only if each shares at least
ceil(0.75 n) of its n shingles, so two linked documents share one of the first
n - ceil(0.75 n) + 1 shingles of each in any common order.  The order here is rarest first
by a count sketch of fixed size over all documents, then by hash: common passages come
last.

1. One pass makes the sketch and a fingerprint of each set.  Of documents with one set the
   least id stands for all.
2. A second pass posts each representative under its first shingles.  A tile is the
   documents of one shingle and one size band (two linked sets differ in size by at most
   4 : 3, hence by one band).  Each tile names its least id as leader, and only
   (leader, member) pairs leave it, so a tile of n documents costs n.
3. Candidate pairs are checked: the bit counts of hashed bitmaps bound the overlap from
   above, and pairs that pass get the exact sorted-array intersection.  Links make
   components.
4. Tiles that still hold more than one component are the rest: there, all pairs of members
   of different components and fitting sizes are tested by bitmap, block by block, and
   survivors are checked exactly.  So no link between different components is lost, and
   the pairs inside a component, which cannot change the result, are never made.

Nothing is capped: large tiles are cut into blocks whose pairs are dealt out.

Defined results: null text counts as empty; no words: n_shingles 0, own component; fewer
than five words: the whole sequence is the one shingle; rows that share a doc_id share a
component; rows with a null doc_id get a null component and link with nothing; a text of
any length gives its whole set; an empty table gives no row; other columns, whatever their
names, are not read, and come back unchanged from ``drop_near_copies``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, Tidy, cut, drop, hinted, small_batches
from .graph import components

WORDS = 5
PERCENT = 75
SKETCH_BITS = 20
CHUNK_BITS = 14
BITMAP_BITS = 1024
BLOCK = 4096
LARGE = 8192
SALTS = 16
#: Documents that may share a shingle before its postings are dealt over several tasks.
HOT = 16_384
_MASK = (1 << 64) - 1


class _Words(dict):
    """64-bit hashes of words, kept for reuse; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64) of a text, A-Z taken as a-z."""
    parts = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):  # words are hashed already: a polynomial keeps their order
        out = out * np.uint64(0x9FB21C651E98DF25) + h[k : len(h) - width + 1 + k]
    return np.unique(_mix(out))


def need(n, percent: int = PERCENT):
    """Least overlap that a set of n shingles needs for a link."""
    return -(-percent * n // 100)


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Bitmap bound first, then the exact intersection of sorted arrays."""
    n, m = len(x), len(y)
    if not n or not m or 100 * min(n, m) < percent * max(n, m):
        return False
    least = -(-percent * (n + m) // (100 + percent))
    if (n + m - int(np.bitwise_count(bitmap(x) ^ bitmap(y)).sum())) // 2 < least:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= least


def bitmap(x: np.ndarray, bits: int = BITMAP_BITS) -> np.ndarray:
    """``bits`` bits as uint64 words; bit h mod ``bits`` is flipped for each shingle h.

    Two bitmaps differ in at most as many bits as the sets differ in elements.
    """
    odd = np.bincount((x % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def band(n):
    """Size band: sets that can link are in one band or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(100 / PERCENT) + 1e-9).astype(np.int64)


# -- first pass ----------------------------------------------------------------------
_FIRST = "doc_id long, n int, d1 long, d2 long, bits binary, chunk int, counts binary"


def _first_pass(docs: DataFrame, words: int) -> DataFrame:
    size, chunk = 1 << SKETCH_BITS, 1 << CHUNK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(size, np.int32)
        for batch in batches:
            sizes, sums, maps, cells = [], [], [], []
            for text in batch.column(1):
                x = shingles(text.as_py(), words)
                cells.append((x & np.uint64(size - 1)).astype(np.int64))
                sizes.append(len(x))
                maps.append(bitmap(x).tobytes())
                # two sums of independent mixes: 128 bits for a set
                sums.append((int(x.sum()) & _MASK, int(_mix(x ^ np.uint64(_MASK)).sum()) & _MASK))
            if cells:
                sketch += np.bincount(np.concatenate(cells), minlength=size).astype(np.int32)
            k = len(sizes)
            d = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array(maps, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                names,
            )
        k = size // chunk
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()), pa.array([sketch[i * chunk : (i + 1) * chunk].tobytes() for i in range(k)], pa.binary())],
            names,
        )

    names = [f.split()[0] for f in _FIRST.split(", ")]
    return docs.mapInArrow(run, _FIRST)


def _merged_sketch(parts: DataFrame) -> np.ndarray:
    """Sums of the partitions' sketches; its fixed 2^SKETCH_BITS counts reach the driver."""

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in table.column("counts")], axis=0)
        total = np.minimum(total, 2**31 - 1).astype(np.int32)
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    # several partial sums for each chunk keep one chunk's sketches from meeting in one task
    once = parts.withColumn("part", F.pmod(F.monotonically_increasing_id() / (1 << 33), F.lit(64)).cast("int"))
    some = once.groupBy("chunk", "part").applyInArrow(add, "chunk int, counts binary")
    rows = some.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()
    if not rows:  # no input partition at all
        return np.zeros(1 << SKETCH_BITS, np.int32)
    return np.concatenate([np.frombuffer(bytes(r.counts), np.int32) for r in sorted(rows, key=lambda r: r.chunk)])


# -- second pass ---------------------------------------------------------------------
def _postings(docs: DataFrame, sketch, words: int) -> DataFrame:
    size = 1 << SKETCH_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            keys, ids, sizes, salts = [], [], [], []
            for doc, text in zip(*batch.columns, strict=True):
                x = shingles(text.as_py(), words)
                if not len(x):
                    continue
                first = len(x) - need(len(x)) + 1
                often = counts[(x & np.uint64(size - 1)).astype(np.int64)]
                order = np.argsort(often, kind="stable")[:first]
                number = doc.as_py()
                keys.append(x[order])
                ids.append(np.full(first, number, np.int64))
                sizes.append(np.full(first, len(x), np.int32))
                parts = often[order] // HOT
                mixed = int(_mix(np.uint64(number & _MASK)[None])[0] >> np.uint64(33))
                salts.append(np.where(parts > 0, mixed % (parts + 1), -1).astype(np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.concatenate(ids)),
                        pa.array(np.concatenate(sizes)),
                        pa.array(np.concatenate(salts)),
                    ],
                    ["key", "doc", "n", "salt"],
                )

    return docs.mapInArrow(run, "key long, doc long, n int, salt int")


def _whole_runs(batches: Iterator[pa.RecordBatch], least: int = 20_000) -> Iterator[pa.Table]:
    """Batches that are sorted by their first column, regrouped so that no key is cut in two.

    Only the rows of a key that may go on are held back, and no row is copied twice.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        ends = last > 0 or (bool(held) and held[-1].column(0)[-1].as_py() != key[0])
        if ends and size + last >= least:  # all before the batch's last key is whole
            done = [*held, batch.slice(0, last)] if last else held
            yield pa.Table.from_batches(done).combine_chunks()
            held, size, batch = [], 0, batch.slice(last)
        held.append(batch)
        size += batch.num_rows
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _tiles(postings: DataFrame) -> DataFrame:
    """Postings of keys with more than one document, with the leader of their tile.

    Input is dealt by key, and a key that more than ``HOT`` documents may share by a salt too
    (-1: none); each salt has a leader of its own, and :func:`_stars` ties these to one.
    """

    def shared(key, doc, n, salt):
        same = np.zeros(len(key), bool)
        equal = key[1:] == key[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        same |= salt >= 0  # alone in its salt, but not in its key
        key, doc, n, salt = key[same], doc[same], n[same], salt[same]
        b = band(n)
        order = np.lexsort((doc, b, salt, key))
        key, doc, n, salt, b = key[order], doc[order], n[order], salt[order], b[order]
        once = np.ones(len(key), bool)  # rows repeated with their doc_id post once
        once[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (n[1:] != n[:-1])
        key, doc, n, salt, b = key[once], doc[once], n[once], salt[once], b[once]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | (b[1:] != b[:-1])
        lead = doc[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        columns = (key, doc, n, lead, np.where(salt < 0, -1, b))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_runs(batches):
            yield shared(*(whole.column(c).to_numpy() for c in ("key", "doc", "n", "salt")))

    names, types = ["key", "doc", "n", "leader", "hot_band"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    dealt = postings.repartition("key", "salt").sortWithinPartitions("key", "salt")
    return dealt.mapInArrow(run, "key long, doc long, n int, leader long, hot_band int")


def _stars(tiles: DataFrame) -> DataFrame:
    """Pairs of each tile's leader and members, and of the leaders of one hot key's salts."""
    star = tiles.select(F.col("leader").alias("x"), F.col("doc").alias("y"))
    leaders = tiles.where("hot_band >= 0").groupBy("key", "hot_band", "leader").agg(F.lit(1).alias("_")).drop("_")
    first = leaders.groupBy("key", "hot_band").agg(F.min("leader").alias("x"))
    star = star.unionByName(leaders.join(first, ["key", "hot_band"]).select("x", F.col("leader").alias("y")))
    return star.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


# -- checking ------------------------------------------------------------------------
def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with an id in ``ids``."""
    return docs.join(hinted(ids, 32), "doc_id", "left_semi")


def _check_pairs(pairs: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts link, as a table."""
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    texts = cut(_texts_of(docs, ids), "texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
                if last[0] != (a.as_py(), x):
                    last = (a.as_py(), x), shingles(x.as_py(), words)
                keep.append(linked(last[1], shingles(y.as_py(), words)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    links = cut(joined.mapInArrow(run, "a long, b long"), "links")
    drop(ids)
    drop(texts)
    return links


def _rest_pairs(tiles: DataFrame, found: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs of different components that share a tile and pass the bitmap bound.

    ``signed`` has the bitmap of each set: doc, n, bits.
    """
    comp = found.select(F.col("id").alias("doc"), F.col("component").alias("comp"))
    rows = tiles.select("key", "doc", "n").join(comp, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k"))
    mixed = mixed.where("lo < hi").select("key", "k")
    open_rows = cut(rows.join(mixed, "key"), "open-tiles")
    if open_rows.isEmpty():
        return open_rows.select(F.col("doc").alias("a"), F.col("doc").alias("b"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_runs(batches):
            key, doc, n, comp = (whole.column(c).to_numpy() for c in ("key", "doc", "n", "comp"))
            n = n.astype(np.int64)
            bits = np.frombuffer(b"".join(whole.column("bits").to_pylist()), np.uint64).reshape(len(n), -1)
            found, apart = [], 0
            while True:  # rows of one key that stand 1, 2, ... rows apart
                apart += 1
                i = np.nonzero(key[apart:] == key[:-apart])[0]
                if not len(i):
                    break
                j = i + apart
                low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                fit = (comp[i] != comp[j]) & (doc[i] != doc[j]) & (100 * low >= PERCENT * high)
                i, j, total = i[fit], j[fit], (low + high)[fit]
                differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1).astype(np.int64)
                fit = (total - differ) // 2 >= -(-PERCENT * total // (100 + PERCENT))
                found.append(np.stack([np.minimum(doc[i], doc[j])[fit], np.maximum(doc[i], doc[j])[fit]]))
            if found:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    near = open_rows.where(F.col("k") <= LARGE).drop("k").join(signed, ["doc", "n"]).select("key", "doc", "n", "comp", "bits")
    met = near.repartition("key").sortWithinPartitions("key").mapInArrow(runs, "a long, b long")
    large = open_rows.where(F.col("k") > LARGE)
    if large.isEmpty():
        return met.distinct()
    # a large tile's members meet block by block: a member of block i goes to all (i, j) with
    # i <= j and (j, i) with j < i, in its own size band and the next
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc"), blocks).cast("int")
    size_band = F.floor(F.log(F.greatest("n", F.lit(1))) / math.log(100 / PERCENT) + 1e-9).cast("int")
    spread = (
        large.withColumn("own", own)
        .withColumn("tile", F.explode(F.array(size_band, size_band + 1)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", "tile", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc", "n", "comp")
        .join(signed, ["doc", "n"])
    )

    def meet(table: pa.Table) -> pa.Table:
        if table.num_rows < 2:
            return none
        n, doc, comp = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "doc", "comp"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(n), -1)
        order = np.argsort(n, kind="stable")
        n, doc, comp, bits = n[order], doc[order], comp[order], bits[order]
        a, b = [], []
        for k in range(1, len(n)):
            low = int(np.searchsorted(n, need(n[k])))
            fit = np.arange(low, k)
            fit = fit[comp[fit] != comp[k]]
            if len(fit):
                differ = np.bitwise_count(bits[fit] ^ bits[k]).sum(axis=1).astype(np.int64)
                total = n[fit] + n[k]
                fit = fit[(total - differ) // 2 >= -(-PERCENT * total // (100 + PERCENT))]
                a.append(np.minimum(doc[fit], doc[k]))
                b.append(np.maximum(doc[fit], doc[k]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)}, schema=none.schema) if a else none

    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    blocked = spread.groupBy("key", "tile", "i", "j").applyInArrow(meet, "a long, b long")
    return met.union(blocked.where("a < b")).distinct()


# -- the operator --------------------------------------------------------------------
def near_duplicates(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Tidy() as tidy:
        first = cut(_first_pass(docs, words), "sets")
        sketch = spark.sparkContext.broadcast(_merged_sketch(first.where("chunk is not null").select("chunk", "counts")))
        sets = first.where("chunk is null").select("doc_id", "n", "d1", "d2")
        named = sets.where("doc_id is not null and n > 0")
        signed = first.where("doc_id is not null and n > 0").select(F.col("doc_id").alias("doc"), "n", "bits").dropDuplicates()
        # each input partition sends one minimum for a set, however many equal ones it has
        least = (
            named.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("k")).where("k > 1")
        )
        least = cut(least.select("d1", "d2", "n", "rep"), "least")
        # beyond a broadcast's size the sides are salted: a set's rows are dealt over SALTS keys
        few = least.count() * 64 <= BROADCAST_BYTES
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        salted = named.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        by = ["d1", "d2", "n"]
        met = named.join(F.broadcast(least), by) if few else salted.join(least.withColumn("salt", F.explode(salts)), [*by, "salt"])
        copies = cut(met.where("doc_id <> rep").select("doc_id", "rep"), "copies")
        same = copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        # an id that also names another set is not only a copy: it still posts
        many = named.select("doc_id", "d1", "d2").distinct().groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
        gone = cut(copies.select("doc_id").distinct().join(many, "doc_id", "left_anti"), "gone")
        reps = docs.where("doc_id is not null").join(hinted(gone, 32), "doc_id", "left_anti")

        tiles = cut(_tiles(_postings(reps, sketch, words)), "tiles")
        pairs = cut(_stars(tiles), "pairs")
        links = _check_pairs(pairs, reps, words)
        found = cut(components(links), "components")
        rest = cut(_rest_pairs(tiles, found, signed).join(pairs, ["a", "b"], "left_anti"), "rest")
        drop(tiles)
        drop(pairs)
        if not rest.isEmpty():
            links = cut(links.union(_check_pairs(rest, reps, words)), "links")
        if rest.isEmpty() and copies.isEmpty():
            ends = found
        else:
            ends = cut(components(links.union(same)), "components")
        tidy.keep(first, ends)
    ids = ends.select(F.col("id").alias("doc_id"), "component")
    return sets.join(ids, "doc_id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_near_copies(documents: DataFrame) -> DataFrame:
    """``documents`` with the least doc_id of each component; rows with a null doc_id stay."""
    found = near_duplicates(documents).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    rows = documents.select(F.struct(*documents.columns).alias("_own"))
    gone = hinted(cut(found, "near-gone"), 32)
    return rows.join(gone, F.col("_own.doc_id").cast("long") == F.col("_gone"), "left_anti").select("_own.*")
