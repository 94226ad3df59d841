"""WARC derivatives: linked metadata and plain-text conversion records of responses.

Each response gives one ``metadata`` record (its digests, its source headers one by one and
what the page says of itself) and one ``conversion`` record (its text).  Both name the
response in WARC-Refers-To; the conversion carries the response's payload digest as well as
its own block digest.  Ids are made from the response's id and the record's kind, so a
repeated run gives the same records.  Responses come from WARC bytes (``read_responses``),
with their own ids, dates, headers and digests, or are made of crawled pages
(``page_responses``).

A page is read in one pass over its ``<``: an end tag that is missing once is not searched
for again, so a page of any length takes time in proportion.  Field values lose their line
ends and other control characters, so no page can write a field of its own.

Defined results: null or empty payload gives both records, with an empty conversion block;
null url or target an empty target; digests that are missing are computed, given ones kept;
repeated pages are responses of their own, told apart by their row's place in the input
(which must come from files for ids that stay); ties do not occur; an empty table gives no
row; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("7c0e8b0a-5b62-5f3e-9d3a-3f1a7d0b6c11")
RESPONSES = (
    "page_id long, record_id string, target_uri string, date string, headers array<struct<name:string,value:string>>, "
    "payload binary, payload_digest string, block_digest string"
)
SCHEMA = (
    "page_id long, warc_type string, record_id string, refers_to string, target_uri string, date string, "
    "content_type string, source_headers string, payload_digest string, block_digest string, "
    "content_length long, block binary"
)
_HEADERS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
_RESPONSE_TYPES = [pa.int64(), *[pa.string()] * 3, _HEADERS, pa.binary(), pa.string(), pa.string()]
_TYPES = [pa.int64(), *[pa.string()] * 9, pa.int64(), pa.binary()]

#: Elements whose text is not seen, and those that end a line.
_SKIPPED = frozenset("script style noscript template".split())
_BREAKS = frozenset(
    "p div br hr li ul ol dl dt dd table tr h1 h2 h3 h4 h5 h6 section article header footer nav aside main pre blockquote form figure".split()
)
_TAG = re.compile(r"<(?:(!--)|(/?)([A-Za-z][A-Za-z0-9]*)[^>]*>|[!?/][^>]*>)")
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*_SKIPPED, "head", "title")}
_LANG = re.compile(r"\slang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_HREF = re.compile(r"\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
_CONTROL = re.compile("[\x00-\x1f\x7f-\x9f  ]+")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9._-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join(map(str, parts)))}>"


def field(value: str | None) -> str:
    """A value that fits on one line of a header."""
    return " ".join(_CONTROL.sub(" ", value or "").split())


def _unescaped(text: str) -> str:
    """Character references resolved; numbers too long to be one are no character."""
    text = re.sub(r"&#0+(?=[0-9])", "&#", text)
    return html.unescape(re.sub(r"&#[0-9]{8,}", "&#1114112", text))


class Page:
    """Text, title, language and links of an HTML page."""

    def __init__(self, page: str) -> None:
        self.title: str | None = None
        self.lang = ""
        self.links: list[str] = []
        self._ends: dict[str, re.Match | None] = {}
        self._page = page
        parts = list(self._read(page))
        lines = (_BLANKS.sub(" ", line).strip() for line in _unescaped("".join(parts)).split("\n"))
        self.text = "\n".join(filter(None, lines))
        self.title = " ".join(_unescaped(self.title or "").split())

    def _end(self, name: str, at: int) -> int | None:
        """Where the element that is open at ``at`` ends; no part of the page is searched twice for it."""
        if name not in self._ends or ((last := self._ends[name]) and last.start() < at):
            self._ends[name] = _ENDS[name].search(self._page, at)
        found = self._ends[name]
        return found and found.end()

    def _read(self, page: str) -> Iterator[str]:
        # after the last > there is no tag, so that no search for one runs to the end in vain
        at, stop, hidden, comments = 0, page.rfind(">") + 1, 0, True
        search = _TAG.search
        while found := search(page, at, stop):
            start, end = found.span()
            if start > at >= hidden:
                yield page[at:start]
            at = end
            comment, close, name = found.groups()
            if comment:
                done = page.find("-->", end) if comments else -1
                comments = done >= 0
                at = done + 3 if comments else page.find(">", end) + 1
                if comments:
                    yield " "
                continue
            if not name:
                continue
            kind = name.lower()
            if kind in _BREAKS:
                if start >= hidden:
                    yield "\n"
            elif close:
                continue
            elif kind in _SKIPPED:
                at = self._end(kind, end) or end
                yield " "
            elif kind == "a":
                if start >= hidden and (link := _HREF.search(page, start, end)):
                    self.links.append(field(_unescaped(link[1] or link[2] or link[3] or "")))
            elif kind == "head":
                hidden = max(hidden, self._end(kind, end) or 0)
            elif kind == "title" and self.title is None:
                done = self._end(kind, end)
                self.title = page[end : page.rfind("<", end, done)] if done else None
            elif kind == "html" and not self.lang:
                language = _LANG.search(page, start, end)
                self.lang = language[1] if language else ""
        if at >= hidden:
            yield page[at:]


def plain_text(page: str) -> str:
    """Visible text: a line for each block, runs of blanks as one, no empty lines."""
    return Page(page).text


# -- responses -----------------------------------------------------------------------
def response(page_id: int | None, url: str | None, page: str | None, date: str = DATE, place: int = 0) -> tuple:
    """A response of a crawled page, as RESPONSES; ``place`` tells repeated pages apart."""
    payload = (page or "").encode()
    headers = [{"name": "Content-Type", "value": "text/html; charset=utf-8"}, {"name": "Content-Length", "value": str(len(payload))}]
    head = "HTTP/1.1 200 OK\r\n" + "".join(f"{h['name']}: {h['value']}\r\n" for h in headers) + "\r\n"
    own = record_id("response", page_id, url or "", digest(payload), place)
    return page_id, own, url or "", date, headers, payload, digest(payload), digest(head.encode() + payload)


def _batch(rows: list[tuple], schema: str, types: list) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def page_responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """RESPONSES of pages (page_id, url, html), without any exchange."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [response(i.as_py(), u.as_py(), h.as_py(), date, at.as_py()) for i, u, h, at in zip(*batch.columns, strict=True)]
            yield _batch(rows, RESPONSES, _RESPONSE_TYPES)

    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.monotonically_increasing_id().alias("place"),
    )
    return slim.mapInArrow(run, RESPONSES)


def _named_lines(head: bytes) -> list[tuple[str, str]]:
    """(name, value) of header lines; a line that begins with a blank goes on with the one before."""
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split("\n"):
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and out:
            out[-1] = out[-1][0], f"{out[-1][1]} {line.strip()}"
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


def records(file: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of the records of an uncompressed WARC stream."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one must begin")
        head = []
        while (line := file.readline()).strip():
            head.append(line)
        named = {name.lower(): value for name, value in _named_lines(b"".join(head))}
        length = int(named.get("content-length", "0"))
        block = file.read(length)
        if len(block) < length:
            raise ValueError("a WARC record ends before its length")
        yield named, block


def http_parts(block: bytes) -> tuple[list[dict], bytes]:
    """Header fields and payload of an HTTP message; a block that is none is all payload."""
    if not block.startswith(b"HTTP/"):
        return [], block
    ends = [(at, size) for mark, size in ((b"\r\n\r\n", 4), (b"\n\n", 2)) if (at := block.find(mark)) >= 0]
    at, size = min(ends, default=(len(block), 0))
    lines = block[:at].split(b"\n", 1)
    named = _named_lines(lines[1]) if len(lines) > 1 else []
    return [{"name": n, "value": v} for n, v in named], block[at + size :]


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """RESPONSES of the response records of ``.warc`` and ``.warc.gz`` files; page_id is null.

    A file is one task and is read as a stream of records; Spark hands it over as one value
    (2 GiB at most).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = io.BytesIO(memoryview(content.as_buffer()))
                packed = data.read(2) == b"\x1f\x8b"
                data.seek(0)
                for named, block in records(gzip.GzipFile(fileobj=data) if packed else data):
                    if named.get("warc-type", "").lower() == "response":
                        headers, payload = http_parts(block)
                        own = named.get("warc-record-id") or record_id("response", digest(block))
                        row = (
                            None, own, named.get("warc-target-uri", ""), named.get("warc-date", ""), headers, payload,
                            named.get("warc-payload-digest") or digest(payload), named.get("warc-block-digest") or digest(block),
                        )
                        yield _batch([row], RESPONSES, _RESPONSE_TYPES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RESPONSES)


# -- derivatives ---------------------------------------------------------------------
def _decoded(payload: bytes, headers: list[tuple[str, str]]) -> str:
    named = next((m[1] for n, v in headers if n.lower() == "content-type" and (m := _CHARSET.search(v))), "utf-8")
    try:
        return payload.decode(named, "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive(page_id, own, target, date, headers, payload, payload_digest, block_digest) -> list[tuple]:
    """The metadata and the conversion record of a response, as SCHEMA."""
    payload = payload or b""
    named = [(field(h["name"]), field(h["value"])) for h in headers or []]
    page = Page(_decoded(payload, named))
    payload_digest = payload_digest or digest(payload)
    fields = [
        ("source-record", own),
        ("source-block-digest", block_digest or ""),
        ("source-payload-digest", payload_digest),
        *(("source-header", f"{name}: {value}") for name, value in named),
        ("title", page.title),
        ("lang", page.lang),
        *(("outlink", x) for x in page.links),
    ]
    about = "".join(f"{k}: {field(v)}\r\n" for k, v in fields).encode("utf-8", "replace")
    source_headers = json.dumps(named, separators=(",", ":"), ensure_ascii=False)
    out = []
    for kind, content, block in (
        ("metadata", "application/warc-fields", about),
        ("conversion", "text/plain; charset=utf-8", page.text.encode("utf-8", "replace")),
    ):
        derived = record_id(kind, own)
        out.append(
            (page_id, kind, derived, own, field(target), field(date), content, source_headers, payload_digest, digest(block), len(block), block)
        )
    return out


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows of SCHEMA for each of RESPONSES, without any exchange."""
    small_batches(responses.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for source in zip(*batch.columns, strict=True) for row in derive(*(x.as_py() for x in source))]
            yield _batch(rows, SCHEMA, _TYPES)

    return responses.select(*(f.split()[0] for f in RESPONSES.split(", "))).mapInArrow(run, SCHEMA)


def serialise(row) -> bytes:
    """A record of SCHEMA as one gzip member of a WARC 1.1 file."""
    head = [
        ("WARC-Type", row.warc_type),
        ("WARC-Record-ID", row.record_id),
        ("WARC-Refers-To", row.refers_to),
        ("WARC-Target-URI", row.target_uri),
        ("WARC-Date", row.date),
        ("WARC-Payload-Digest", row.payload_digest),
        ("WARC-Block-Digest", row.block_digest),
        ("Content-Type", row.content_type),
        ("Content-Length", str(row.content_length)),
    ]
    lines = "".join(f"{name}: {field(value)}\r\n" for name, value in head)
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + bytes(row.block) + b"\r\n\r\n", mtime=0)


def write_files(derived: DataFrame, path: str) -> DataFrame:
    """One .warc.gz file for each partition; gives (file, records, bytes).

    Files are written under another name and then moved: a repeated task leaves one file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from types import SimpleNamespace

        from pyarrow import fs
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root)
        aside = f"{root}/_{context.partitionId():06d}-{context.taskAttemptId()}"
        name = f"part-{context.partitionId():06d}.warc.gz"
        n = size = 0
        with store.open_output_stream(aside, compression=None) as sink:
            for batch in batches:
                for row in batch.to_pylist():
                    data = serialise(SimpleNamespace(**row))
                    sink.write(data)
                    n, size = n + 1, size + len(data)
        store.move(aside, f"{root}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([size])], ["file", "records", "bytes"])

    return derived.mapInArrow(run, "file string, records long, bytes long")
