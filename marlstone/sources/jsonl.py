"""Bronze scan of JSONL files: physical identity before parsing, quarantine, row accounting.

Each physical line becomes a row, valid or quarantined with one code, so input rows always
equal valid plus quarantined rows.  A line ends at LF or CR LF only.  Registering digests each
file in byte ranges and counts the lines of each; ingesting gives a task each range, whose
bytes are verified as they are parsed (:mod:`.ranges`).  Where only Spark's own readers can open the
store, its line reader cuts the files, and they are verified before the read.

Defined results: an empty file has no lines; a last line without LF is a line, and keeps a CR at its
end; a line beyond the limit has no text; null does not occur; a file that is not the registered
one fails the read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jcs import canonical, stable_id
from ..functions.strict_json import loads, record
from . import ranges
from .publish import publish_shards

MAX_RECORD_BYTES = 8 << 20
SCHEMA = ranges.BRONZE_SCHEMA


def _relative(path: str, root: str) -> str:
    return path.split(root.rstrip("/").split("://")[-1].split(":", 1)[-1] + "/", 1)[-1]


def register(spark: SparkSession, root: str, namespace: str, revision: str, range_bytes: int = ranges.RANGE_BYTES) -> dict:
    """Snapshot of the ``*.jsonl`` files under ``root``: relative path, digest, size, lines, and each file's ``ranges``
    (start, size, digest, lines that begin there)."""
    by_file: dict[str, list] = {}
    if ranges.readable(root):
        found = ranges.file_ranges(spark, root, range_bytes).collect()  # one small row for each byte range
        for r in sorted(found, key=lambda r: (r.relative_path, r.start)):
            by_file.setdefault(r.relative_path, []).append([r.start, r.size, r.sha256, r.n_lines])
        whole = {r.relative_path: r for r in found if r.file_sha256}
        entries = [{"relative_path": path, "sha256": whole[path].file_sha256, "size": whole[path].file_size, "lines": sum(x[3] for x in own)} for path, own in by_file.items()]
    else:
        entries = _entries(spark, root)
    if not entries:
        raise ValueError("no .jsonl file")
    identity = {
        "id_version": 1,
        "dataset_namespace": namespace,
        "source_revision": revision,
        "files": [{k: x[k] for k in ("relative_path", "sha256", "size")} for x in entries],
    }
    return {
        "snapshot_id": stable_id("snap", identity),
        "dataset_namespace": namespace,
        "source_revision": revision,
        "root": root,
        "files": entries,
        "ranges": by_file,
        "record_count": sum(x["lines"] for x in entries),
    }


def _entries(spark: SparkSession, root: str) -> list[dict]:
    """The files' entries by Spark's reader, each file as one value (2 GiB at most)."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.jsonl")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", F.sha2("content", 256).alias("sha"), "length", _lines().alias("lines"))
    )
    return sorted(
        ({"relative_path": _relative(r.path, root), "sha256": f"sha256:{r.sha}", "size": r.length, "lines": r.lines} for r in files.collect()),
        key=lambda x: x["relative_path"],
    )


def _lines():
    """LF bytes, plus one where the last line has no LF."""
    # Latin-1 has a character for each byte
    text = F.decode("content", "ISO-8859-1")
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (ends + F.when((F.length(text) > 0) & ~text.endswith("\n"), 1).otherwise(0)).cast("long")


def verify(spark: SparkSession, snapshot: dict) -> None:
    """Fail where a file is not the registered one any more; call it before and after a read."""
    found = {x["relative_path"]: x for x in register(spark, snapshot["root"], snapshot["dataset_namespace"], snapshot["source_revision"])["files"]}
    for known in snapshot["files"]:
        if found.get(known["relative_path"]) != known:
            raise ValueError(f"{known['relative_path']} changed since it was registered")
    if len(found) != len(snapshot["files"]):
        raise ValueError("a file came after the registration")


def _ranged_lines(spark: SparkSession, root: str) -> DataFrame:
    """(path, start, line): lines as bytes, in order inside each byte range."""
    reader = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "true").option("lineSep", "\n")
    lines = reader.text(root)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )


def ingest(spark: SparkSession, snapshot: dict, limit: int = MAX_RECORD_BYTES, id_field: str = "id", cap: int | None = None) -> DataFrame:
    """Rows of SCHEMA; ``cap`` keeps the first so many lines of each file.

    Sizes are compared first, and each range's bytes as they are parsed.
    """
    if snapshot.get("ranges"):
        return ranges.bronze(spark, snapshot, limit, id_field, cap)
    return _by_spark_reader(spark, snapshot, limit, id_field, cap)


def _by_spark_reader(spark: SparkSession, snapshot: dict, limit: int, id_field: str, cap: int | None) -> DataFrame:
    """The same rows by Spark's line reader; the files are verified before the read, :func:`verify` does it after."""
    verify(spark, snapshot)
    known = [x["relative_path"] for x in snapshot["files"]]
    root, namespace, snap = snapshot["root"], snapshot["dataset_namespace"], snapshot["snapshot_id"]
    names = [f.strip().split()[0] for f in SCHEMA.split(",")]
    ranged = _ranged_lines(spark, root)
    sums = ranged.groupBy("path", "start").agg(F.sum(F.octet_length("line") + 1).alias("size"), F.count("*").alias("n")).collect()
    # one entry for each byte range
    places: dict[tuple[str, int], tuple[str, int, int, int]] = {}
    ordered = sorted((known.index(_relative(unquote(r.path), root)), r.start, r.path, r.size, r.n) for r in sums)
    at = line = sequence = 0
    last = None
    for file, start, path, size, n in ordered:
        if file != last:
            last, at, line = file, 0, 0
        places[path, start] = (known[file], at, line, sequence)
        at, line, sequence = at + size, line + n, sequence + n
    before = spark.sparkContext.broadcast(places)

    def row(relative: str, at: int, number: int, sequence: int, raw: bytes) -> tuple:
        raw = raw.removesuffix(b"\r")
        value, canonical, code = record(raw, limit)
        where = {"id_version": 1, "snapshot_id": snap, "relative_file_path": relative, "byte_offset": at}
        native = value.get(id_field) if value else None
        try:
            text = raw.decode() if 0 < len(raw) <= limit else None
        except UnicodeDecodeError:
            text = None
        return (
            namespace, snap, stable_id("occ", where), relative, at, len(raw), number, sequence,
            "sha256:" + hashlib.sha256(raw).hexdigest(), text, canonical,
            str(native) if isinstance(native, str | int) else None,
            ["/" + k.replace("~", "~0").replace("/", "~1") for k in value] if value else [],
            "quarantined" if code else "valid", code,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple[str, int], list] = {}
        for batch in batches:
            out = []
            for path, start, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = state.setdefault((path, start), list(before.value[path, start]))
                relative, at, line, sequence = now
                now[1:] = at + len(raw) + 1, line + 1, sequence + 1
                if cap is None or line < cap:
                    out.append(row(relative, at, line + 1, sequence + 1, raw))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)

    text, number = pa.string(), pa.int64()
    types = [text, text, text, text, number, number, number, number, text, text, text, text, pa.list_(text), text, text]
    return ranged.mapInArrow(run, SCHEMA)


def strict(bronze: DataFrame) -> DataFrame:
    """The parsed records in order of nothing but themselves; the first quarantined line fails the query with its code."""
    where = F.concat_ws(" ", "code", F.lit("at"), "relative_file_path", F.lit("line"), F.col("source_line").cast("string"))
    parsed = F.when(F.col("status") == "valid", F.col("parsed_record")).otherwise(F.raise_error(where).cast("string"))
    return bronze.select("relative_file_path", "source_line", "source_sequence", parsed.alias("parsed_record"))


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(sequence, line) of a JSON file that holds one array of objects; anything else fails.

    One JSON value is one file and is parsed in one task; the rows it gives are Spark's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                items = loads(content.as_py())
                if not isinstance(items, list) or not all(isinstance(x, dict) for x in items):
                    raise ValueError("the file must hold one array of objects")
                for at in range(0, len(items), 1000):
                    part = items[at : at + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(range(at + 1, at + 1 + len(part)), pa.int64()), pa.array([canonical(x) for x in part])], ["sequence", "line"]
                    )

    if not path.lower().endswith(".json"):
        raise ValueError("the input must be a .json file")
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "sequence long, line string")


def array_to_jsonl(spark: SparkSession, path: str, root: str) -> dict:
    """Publish the array's objects as canonical JSONL under ``root``; a report of both sides by content."""
    inside = lambda a, b: (a.rstrip("/") + "/").startswith(b.rstrip("/") + "/")
    parent = path.rpartition("/")[0]
    if inside(root, parent) or inside(parent, root):
        raise ValueError("the output must lie apart from the input's folder")
    source = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("sha"), "length").first()
    manifest = publish_shards(array_records(spark, path), root, "source-array", "jsonl-0.1.0", "source", ["sequence"], shard_rows=1 << 62)
    made = manifest["artifacts"][0]
    body = {
        "schema_version": "json-array-conversion-0.1.0",
        "input_file_sha256": f"sha256:{source.sha}",
        "input_byte_size": source.length,
        "input_record_count": made["row_count"],
        "output_file_sha256": made["sha256"],
        "output_byte_size": made["size"],
        "output_record_count": made["row_count"],
        "output_relative_path": made["relative_path"],
    }
    return {"conversion_id": stable_id("convert", body), **body}


def accounting(bronze: DataFrame) -> DataFrame:
    """input = valid + quarantined, with one row."""
    return bronze.agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col("status") == "valid").alias("valid_rows"),
        F.count_if(F.col("status") == "quarantined").alias("quarantined_rows"),
    )
