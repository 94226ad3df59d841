"""Two Python data sources over JSONL files of any size: what a file's ranges hold, and their lines.

``marlstone_file_ranges`` reads each file once, in pieces, in one task: a row for each byte range
with its digest and the number of lines that begin in it, and the digest of the whole file (which
the snapshot's identity names, and which only one reader in order can make).
``marlstone_bronze`` gives a task each registered range.  The task digests the bytes that it
parses and fails where they are not the registered ones, so rows come from verified bytes
only; a line belongs to the range in which it begins, and its reader goes on past the range's end.
No file, range or line is ever one value: a line beyond the limit is digested in pieces and
quarantined without its text.

Stores are opened by ``pyarrow.fs``, in tasks.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.jcs import stable_id
from ..functions.strict_json import record

RANGE_BYTES = 128 << 20
PIECE_BYTES = 4 << 20
#: Rows and bytes of text in an Arrow batch.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

RANGES_SCHEMA = "relative_path string, start long, size long, sha256 string, n_lines long, file_size long, file_sha256 string"
BRONZE_SCHEMA = (
    "dataset_namespace string, snapshot_id string, source_occurrence_id string, relative_file_path string, "
    "byte_offset long, byte_length long, source_line long, source_sequence long, raw_record_sha256 string, raw_record_utf8 string, "
    "parsed_record string, source_native_id string, observed_paths array<string>, status string, code string"
)


def store_of(root: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(root)
    return store, path.rstrip("/")


def readable(root: str) -> bool:
    """Whether tasks can open files under ``root`` without Spark's own readers."""
    try:
        store_of(root)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def listed(root: str) -> dict[str, int]:
    """Size by relative path of the ``*.jsonl`` files under ``root``; hidden names (``.`` and ``_``) are left out."""
    store, base = store_of(root)
    found = store.get_file_info(fs.FileSelector(base, recursive=True))
    files = {f.path[len(base) + 1 :]: f.size for f in found if f.type == fs.FileType.File and f.path.endswith(".jsonl")}
    return {path: size for path, size in sorted(files.items()) if not any(part[0] in "._" for part in path.split("/"))}


@dataclass
class FilePart(InputPartition):
    relative_path: str
    size: int


@dataclass
class Span(InputPartition):
    """A registered range, and how many lines come before it in its file and in all files."""

    relative_path: str
    start: int
    size: int
    sha256: str
    line: int
    sequence: int


class RangesReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.range_bytes = options["path"], int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[FilePart]:
        return [FilePart(path, size) for path, size in listed(self.root).items()] or [FilePart("", 0)]

    def read(self, partition: FilePart) -> Iterator[tuple]:
        if not partition.relative_path:
            return
        store, base = store_of(self.root)
        whole, at, ended, row = hashlib.sha256(), 0, True, None
        with store.open_input_stream(f"{base}/{partition.relative_path}") as stream:
            while True:
                start, own, lines = at, hashlib.sha256(), int(ended)
                while left := self.range_bytes - (at - start):
                    piece = stream.read(min(left, PIECE_BYTES))
                    if not piece:
                        break
                    own.update(piece)
                    whole.update(piece)
                    lines += piece.count(b"\n")  # each begins a line at the byte after it
                    ended = piece.endswith(b"\n")
                    at += len(piece)
                if at > start:
                    if row:
                        yield (*row, None, None)
                    row = (partition.relative_path, start, at - start, f"sha256:{own.hexdigest()}", lines - ended)  # the last one's may be the next range's
                if at - start < self.range_bytes:
                    break
        row = row or (partition.relative_path, 0, 0, f"sha256:{whole.hexdigest()}", 0)
        yield (*row, at, f"sha256:{whole.hexdigest()}")


class _Line:
    """A line that comes in parts; beyond ``limit`` bytes only its digest and length are kept."""

    def __init__(self, offset: int, limit: int) -> None:
        self.offset, self.limit, self.size = offset, limit, 0
        self._parts: list[bytes] = []
        self._digest, self._held = None, b""

    def add(self, part: bytes) -> None:
        self.size += len(part)
        if self._digest is None:
            self._parts.append(part)
            if self.size > self.limit + 1:  # one more may be the CR of the line's end
                self._digest, parts = hashlib.sha256(), self._parts
                self._parts = []
                for one in parts:
                    self._hash(one)
        else:
            self._hash(part)

    def _hash(self, part: bytes) -> None:
        """Digest all but the last byte so far, which may be the CR of the line's end."""
        if part:
            self._digest.update(self._held)
            self._digest.update(memoryview(part)[:-1])
            self._held = part[-1:]

    def end(self, by_line_feed: bool) -> tuple[int, bytes | None, int, str]:
        """(offset, bytes or None, length, digest) without the line's end."""
        if self._digest is None:
            raw = b"".join(self._parts)
            raw = raw.removesuffix(b"\r") if by_line_feed else raw
            return self.offset, raw, len(raw), hashlib.sha256(raw).hexdigest()
        carriage = by_line_feed and self._held == b"\r"
        if not carriage:
            self._digest.update(self._held)
        return self.offset, None, self.size - carriage, self._digest.hexdigest()


def lines_of(stream, start: int, size: int, limit: int, own) -> Iterator[tuple[int, bytes | None, int, str]]:
    """The lines that begin in ``size`` bytes from ``start``; the range's bytes go through ``own``."""
    stop = start + size
    line = _Line(start, limit)
    if start:
        stream.seek(start - 1)
        if stream.read(1) != b"\n":
            line = None  # the range begins inside a line of another
    else:
        stream.seek(0)
    at = start
    while line is not None or at < stop:
        piece = stream.read(min(PIECE_BYTES, stop - at) if at < stop else min(PIECE_BYTES, 1 << 16))
        if not piece:
            break
        if at < stop:
            own.update(piece)
        low = 0
        while (high := piece.find(b"\n", low)) >= 0:
            if line is not None:
                line.add(piece[low:high])
                yield line.end(True)
            low = high + 1
            line = _Line(at + low, limit) if at + low < stop else None
            if line is None and at >= stop:
                return
        if line is not None:
            line.add(piece[low:])
        at += len(piece)
    if line is not None and line.size:
        yield line.end(False)


class BronzeReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.limit = options["path"], int(options["limit"])
        self.id_field, self.cap = options["idfield"], int(options.get("cap", -1))
        self.namespace, self.snapshot_id = options["namespace"], options["snapshotid"]
        self.ranges = options["ranges"]

    def partitions(self) -> list[Span]:
        known: dict[str, list] = json.loads(self.ranges)
        found = listed(self.root)
        if found.keys() - known.keys():
            raise ValueError("a file came after the registration")
        spans, sequence = [], 0
        for path, ranges in known.items():
            if found.get(path) != sum(size for _, size, _, _ in ranges):
                raise ValueError(f"{path} changed since it was registered")
            line = 0
            for start, size, sha256, n_lines in ranges:
                if self.cap < 0 or line < self.cap:
                    spans.append(Span(path, start, size, sha256, line, sequence))
                line, sequence = line + n_lines, sequence + n_lines
        return spans or [Span("", 0, 0, "", 0, 0)]

    def _row(self, span: Span, number: int, at: int, raw: bytes | None, size: int, sha256: str) -> tuple:
        value, parsed, code = (None, None, "PARSE_RECORD_TOO_LARGE") if raw is None or size > self.limit else record(raw, self.limit)
        text = None
        if raw and size <= self.limit:
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                pass
        native = value.get(self.id_field) if value else None
        where = {"id_version": 1, "snapshot_id": self.snapshot_id, "relative_file_path": span.relative_path, "byte_offset": at}
        return (
            self.namespace, self.snapshot_id, stable_id("occ", where), span.relative_path, at, size, span.line + number, span.sequence + number,
            f"sha256:{sha256}", text, parsed, str(native) if isinstance(native, str | int) else None,
            ["/" + k.replace("~", "~0").replace("/", "~1") for k in value] if value else [],
            "quarantined" if code else "valid", code,
        )

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if not partition.relative_path:
            return
        text, number = pa.string(), pa.int64()
        kinds = [text, text, text, text, number, number, number, number, text, text, text, text, pa.list_(text), text, text]
        names = [part.split()[0] for part in BRONZE_SCHEMA.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)

        store, base = store_of(self.root)
        own, rows, held = hashlib.sha256(), [], 0
        with store.open_input_file(f"{base}/{partition.relative_path}") as stream:
            for place, line in enumerate(lines_of(stream, partition.start, partition.size, self.limit, own), 1):
                if 0 <= self.cap < partition.line + place:
                    continue  # the range is digested to its end all the same
                rows.append(self._row(partition, place, *line))
                held += line[2]
                if len(rows) == BATCH_ROWS or held > BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
        if f"sha256:{own.hexdigest()}" != partition.sha256:
            raise ValueError(f"{partition.relative_path} changed since it was registered")
        if rows:
            yield batch(rows)


class FileRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "marlstone_file_ranges"

    def schema(self) -> str:
        return RANGES_SCHEMA

    def reader(self, schema) -> RangesReader:
        return RangesReader(self.options)


class Bronze(DataSource):
    @classmethod
    def name(cls) -> str:
        return "marlstone_bronze"

    def schema(self) -> str:
        return BRONZE_SCHEMA

    def reader(self, schema) -> BronzeReader:
        return BronzeReader(self.options)


def register_sources(spark: SparkSession, *sources: type[DataSource]) -> None:
    """Make data sources known to this session, also in a thread that has no active session yet:
    Spark looks them up in the active one, which ``createDataFrame`` sets."""
    spark.createDataFrame([(0,)], "n int")
    for source in sources:
        spark.dataSource.register(source)


def file_ranges(spark: SparkSession, root: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row for each byte range of each file under ``root``; whole files' values stand on their last range."""
    register_sources(spark, FileRanges)
    return spark.read.format(FileRanges.name()).option("rangeBytes", range_bytes).load(root)


def bronze(spark: SparkSession, snapshot: dict, limit: int, id_field: str, cap: int | None) -> DataFrame:
    """Rows of BRONZE_SCHEMA of the registered files."""
    register_sources(spark, Bronze)
    options = {"limit": limit, "idField": id_field, "namespace": snapshot["dataset_namespace"], "snapshotId": snapshot["snapshot_id"], "ranges": json.dumps(snapshot["ranges"])}
    if cap is not None:
        options["cap"] = cap
    return spark.read.format(Bronze.name()).options(**options).load(snapshot["root"])
