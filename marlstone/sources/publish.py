"""Immutable JSONL shards named by their content, and the manifest that lists them.

Rows are ranked over all partitions, cut into shards of ``shard_rows`` and written through the
transactional sink (:mod:`.sink`): executors stream each shard to a pending file, and only when
all are there do they get their names and the manifest is written.  A file that is there
already has the same content, as its name is its hash, and is kept: publishing again changes nothing.

Defined results: no rows give one empty shard; null lines are an error; equal order keys
are put in order of the lines themselves, so repeated rows cannot change the bytes.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jcs import arr, canonical, json_string, obj, stable_id
from ..functions.strict_json import loads
from ..operators.selection import ordered_rank
from .ranges import register_sources
from .sink import PublishError, Shards, receipt


def _payload(lines: list[str]) -> bytes:
    return "".join(f"{line}\n" for line in lines).encode()


def _put(uri: str, payload: bytes) -> None:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0])
    with store.open_output_stream(path) as sink:
        sink.write(payload)


def publish_shards(
    rows: DataFrame,
    root: str,
    name: str,
    schema_version: str,
    stage: str,
    order: list[str],
    line: str = "line",
    shard_rows: int = 10_000,
    inputs: tuple[str, ...] = (),
    quarantined: int = 0,
    contracts: dict[str, str] | None = None,
) -> dict:
    """Publish the column ``line`` (canonical JSON) in ``order`` under the URI ``root``; the manifest."""
    if shard_rows < 1:
        raise ValueError("shards hold at least one row")
    root, job = root.rstrip("/"), uuid.uuid4().hex
    ranked = ordered_rank(rows.select(*{*order, line}), [*order, line] if line not in order else order, "_rank")
    cut = ranked.select((F.floor((F.col("_rank") - 1) / shard_rows)).cast("long").alias("shard"), "_rank", F.col(line).alias("line"))
    dealt = cut.repartition("shard").sortWithinPartitions("shard", "_rank").select("shard", "line")
    plan = {"name": name, "schema_version": schema_version, "stage": stage, "inputs": list(inputs), "quarantined": quarantined, "contracts": contracts or {}}
    register_sources(rows.sparkSession, Shards)
    try:
        dealt.write.format(Shards.name()).option("plan", canonical(plan)).option("job", job).mode("append").save(root)
    except Exception as error:
        said = re.search(r"PublishError: (.*)", str(error))
        raise (PublishError(said[1]) if said else error) from error
    return receipt(root, job)


# -- reading back --------------------------------------------------------------------
def manifest_faults(manifest: dict) -> list[str]:
    """What a manifest says that does not hold in itself."""
    body = {k: v for k, v in manifest.items() if k != "manifest_id"}
    names = [a["logical_name"] for a in manifest.get("artifacts", [])]
    accounting = manifest.get("row_accounting", {})
    rules = (
        (manifest.get("manifest_id") != stable_id("manifest", body), "identity"),
        (names != sorted(set(names)), "artifacts_not_sorted_or_repeated"),
        (manifest.get("input_manifest_ids") != sorted(set(manifest.get("input_manifest_ids") or [])), "inputs_not_sorted_or_repeated"),
        (accounting.get("input") != accounting.get("accepted", 0) + accounting.get("quarantined", 0), "rows_do_not_add_up"),
        (accounting.get("accepted") != sum(a["row_count"] for a in manifest.get("artifacts", [])), "rows_of_artifacts_differ"),
    )
    return [name for test, name in rules if test]


def _get(uri: str) -> bytes:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as source:
        return source.read()


def resolve(root: str, manifest_id: str) -> dict:
    """The manifest of that id under ``root``, checked in itself."""
    manifest = loads(_get(f"{root.rstrip('/')}/{manifest_id}.json"))
    if not isinstance(manifest, dict) or manifest.get("manifest_id") != manifest_id or (faults := manifest_faults(manifest)):
        raise PublishError(f"{manifest_id} does not hold: {faults if isinstance(manifest, dict) else 'no object'}")
    return manifest


def stage_states(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """(stage, manifest_id, n_artifacts, n_rows, state) of the manifests under each stage's root; a stage without one is ``missing``."""
    rows = []
    for stage, root in roots.items():
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(root)
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        names = sorted(f.base_name for f in found if f.base_name.startswith("manifest_") and f.base_name.endswith(".json"))
        if not names:
            rows.append((stage, None, 0, 0, "missing"))
        for name in names:
            manifest = loads(_get(f"{root.rstrip('/')}/{name}"))
            state = "invalid" if manifest_faults(manifest) else "complete"
            rows.append((stage, manifest["manifest_id"], len(manifest["artifacts"]), sum(a["row_count"] for a in manifest["artifacts"]), state))
    return spark.createDataFrame(rows, "stage string, manifest_id string, n_artifacts long, n_rows long, state string")


def artifact_faults(spark: SparkSession, root: str, manifest: dict) -> DataFrame:
    """(relative_path, fault) of the artifacts whose bytes or rows are not those that the manifest names.

    Each file is hashed in a task of its own.
    """
    known = spark.createDataFrame(
        [(a["relative_path"], a["sha256"], a["row_count"]) for a in manifest["artifacts"]], "relative_path string, sha256 string, row_count long"
    )
    content = F.decode("content", "ISO-8859-1")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").load(root)
    seen = files.select(
        F.element_at(F.split("path", "/"), -1).alias("relative_path"),
        F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("found"),
        (F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit("")))).cast("long").alias("n"),
    )
    both = known.join(seen, "relative_path", "left")
    fault = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("sha256"), "other_bytes").when(F.col("n") != F.col("row_count"), "other_rows")
    return both.select("relative_path", fault.alias("fault")).where("fault is not null")


def publish_package(rows: DataFrame, root: str, about: dict, card: str, key: str = "id", line: str = "line") -> dict:
    """A review package: the rows by ``key`` as one or more data files, what they are, a card, and the manifest.

    It is written for people to look at: its state is pending and nothing in it allows to publish.
    """
    manifest = publish_shards(rows, f"{root.rstrip('/')}/data", "train", "package-row-0.1.0", "package", [key], line)
    n = manifest["row_accounting"]["accepted"]
    info = {
        "schema_version": "package-info-0.1.0",
        "manifest_id": manifest["manifest_id"],
        "splits": {"train": n},
        "status": "pending_human_approval",
        "publish_allowed": False,
        **about,
    }
    info = {"package_id": stable_id("package", info), **info}
    base = f"{root.rstrip('/')}/{info['package_id']}"
    _put(f"{base}/dataset_info.json", _payload([canonical(info)]))
    _put(f"{base}/README.md", card.encode())
    return info


def conversation_lines(turns: DataFrame, by: str) -> DataFrame:
    """(by, line): each conversation's messages, in order, as one canonical JSON object for export.

    ``turns`` has ``by``, turn, role and text.
    """
    message = obj(content=json_string(F.col("text")), role=json_string(F.col("role")))
    folded = turns.select(by, "turn", message.alias("m")).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("turn", "m"))).alias("ms"))
    return folded.select(by, obj(id=json_string(F.col(by).cast("string")), messages=arr(F.col("ms.m"))).alias("line"))


def schema_of(df: DataFrame, title: str) -> dict:
    """A JSON Schema (2020-12) of a table's rows."""
    kinds = {"long": "integer", "integer": "integer", "short": "integer", "byte": "integer", "double": "number", "float": "number", "boolean": "boolean"}

    def one(kind) -> dict:
        if isinstance(kind, dict) and kind["type"] == "array":
            return {"type": "array", "items": one(kind["elementType"])}
        if isinstance(kind, dict) and kind["type"] == "struct":
            fields = {f["name"]: one(f["type"]) if not f["nullable"] else {"anyOf": [one(f["type"]), {"type": "null"}]} for f in kind["fields"]}
            return {"type": "object", "additionalProperties": False, "properties": fields, "required": sorted(fields)}
        if isinstance(kind, dict) and kind["type"] == "map":
            return {"type": "object", "additionalProperties": one(kind["valueType"])}
        return {"type": kinds.get(kind, "string")}

    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title, **one(df.schema.jsonValue())}
