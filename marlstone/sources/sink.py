"""A transactional sink of JSONL shards: a Python data source with two phases.

Tasks stream lines, sorted by shard, into files under the job's pending folder, and report each
shard's digest, size and rows.  Only when all tasks have reported does ``commit`` give the shards
their names, which are their contents' digests, and then, last, write the manifest: what no
manifest lists was not published.  ``abort`` removes the pending folder and nothing else, and a task
that fails removes what it has written, so a failed job leaves the root as it was.

A name is given by an exclusive step: a hard link on a local store, which fails where the name is
taken; elsewhere a move after a look, where a second writer of the same name can only bring the
same bytes, as the name says what they are.  A name that is taken must have the same bytes, so
publishing again, or twice at once, changes nothing.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.jcs import canonical, stable_id
from .ranges import store_of

#: Names that one commit gives at a time.
NAMING_THREADS = 16
RECEIPT = "receipt"


class PublishError(RuntimeError):
    pass


@dataclass
class Written(WriterCommitMessage):
    """(shard, digest, size, rows, pending path) of each shard of a task."""

    shards: list[tuple[int, str, int, int, str]] = field(default_factory=list)


def digest_of(store: fs.FileSystem, path: str) -> str:
    digest = hashlib.sha256()
    with store.open_input_stream(path) as found:
        while part := found.read(1 << 20):
            digest.update(part)
    return digest.hexdigest()


def place(store: fs.FileSystem, pending: str, target: str) -> bool:
    """Give a pending file its name, exclusively; False where the name was taken by the same bytes."""
    try:
        if isinstance(store, fs.LocalFileSystem):
            os.link(pending, target)
        elif store.get_file_info(target).type == fs.FileType.NotFound:
            store.move(pending, target)
            return True
        else:
            raise FileExistsError(target)
    except FileExistsError:
        if digest_of(store, pending) != digest_of(store, target):
            raise PublishError(f"{target} is there with other bytes") from None
        store.delete_file(pending)
        return False
    store.delete_file(pending)
    return True


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.root = options["path"]
        self.plan = json.loads(options["plan"])  # name, schema_version, stage, inputs, quarantined, contracts
        self.pending = f"_pending-{options['job']}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = store_of(self.root)
        folder = f"{base}/{self.pending}"
        store.create_dir(folder)
        done, current, sink, path = Written(), None, None, ""
        size = rows = 0
        digest = hashlib.sha256()

        def close() -> None:
            if sink is not None:
                sink.close()
                done.shards.append((current, f"sha256:{digest.hexdigest()}", size, rows, path))

        try:
            for batch in iterator:
                for shard, line in zip(batch.column("shard").to_pylist(), batch.column("line").to_pylist()):
                    if line is None:
                        raise PublishError("a row has no line")
                    if sink is None or shard != current:
                        close()
                        # each attempt of a task has files of its own
                        path, current, size, rows, digest = f"{folder}/{uuid.uuid4().hex}", shard, 0, 0, hashlib.sha256()
                        sink = store.open_output_stream(path)
                    payload = f"{line}\n".encode()
                    sink.write(payload)
                    digest.update(payload)
                    size, rows = size + len(payload), rows + 1
            close()
        except BaseException:
            if sink is not None:
                sink.close()
            for mine in {path, *(s[4] for s in done.shards)} - {""}:
                if store.get_file_info(mine).type != fs.FileType.NotFound:
                    store.delete_file(mine)
            raise
        return done

    def commit(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.root)
        folder = f"{base}/{self.pending}"
        store.create_dir(folder)
        shards = sorted(s for m in messages if m is not None for s in m.shards)
        if not shards:
            path = f"{folder}/empty"
            store.open_output_stream(path).close()
            shards = [(0, f"sha256:{hashlib.sha256().hexdigest()}", 0, 0, path)]
        if [s[0] for s in shards] != list(range(len(shards))):
            raise PublishError("a shard is missing or came from two tasks")
        artifacts = []
        for shard, sha256, size, rows, _ in shards:
            logical = f"{self.plan['name']}-{shard:05d}"
            artifacts.append({
                "logical_name": logical, "relative_path": f"{logical}-{sha256.removeprefix('sha256:')}.jsonl",
                "schema_version": self.plan["schema_version"], "sha256": sha256, "size": size, "row_count": rows,
            })
        with ThreadPoolExecutor(NAMING_THREADS) as pool:
            list(pool.map(lambda both: place(store, both[0][4], f"{base}/{both[1]['relative_path']}"), zip(shards, artifacts, strict=True)))
        accepted, quarantined = sum(a["row_count"] for a in artifacts), self.plan["quarantined"]
        body = {
            "schema_version": "content-manifest-0.1.0",
            "stage": self.plan["stage"],
            "pipeline_version": "0.1.0",
            "input_manifest_ids": sorted(self.plan["inputs"]),
            "artifacts": artifacts,
            "row_accounting": {"input": accepted + quarantined, "accepted": accepted, "quarantined": quarantined},
            "contract_hashes": self.plan["contracts"],
        }
        manifest = body | {"manifest_id": stable_id("manifest", body)}
        for name in ("manifest", RECEIPT):  # the caller finds its manifest in the receipt
            with store.open_output_stream(f"{folder}/{name}") as sink:
                sink.write(f"{canonical(manifest)}\n".encode())
        place(store, f"{folder}/manifest", f"{base}/{manifest['manifest_id']}.json")

    def abort(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.root)
        folder = f"{base}/{self.pending}"
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class Shards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "marlstone_shards"

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options)


def receipt(root: str, job: str) -> dict:
    """The manifest that the job has committed; its pending folder is removed."""
    store, base = store_of(root)
    folder = f"{base}/_pending-{job}"
    with store.open_input_stream(f"{folder}/{RECEIPT}") as found:
        manifest = json.loads(found.read())
    store.delete_dir(folder)
    return manifest
