"""Releases: only a human's acceptance admits an episode, and rows stand in the members' order.

Defined results: a null id matches nothing; a member with several faults names the first
in the order of the chain; an id given twice is a fault of every member that uses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.jcs import canonical, digest, stable_id
from ..functions.strict_json import loads


def _once(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """One row for each key: how often it came, and its columns under a prefix."""
    values = [F.first(c).alias(f"{prefix}_{c}") for c in rows.columns if c != key]
    return rows.groupBy(F.col(key).alias(f"{prefix}_key")).agg(F.count("*").alias(f"{prefix}_n"), *values)


def gold_problems(members: DataFrame, verdicts: DataFrame, reviews: DataFrame, acceptances: DataFrame) -> DataFrame:
    """Each member (episode_id, verdict_id, human_review_id) with its first fault, null for none.

    verdicts: verdict_id, episode_id; reviews: review_id, verdict_id, authority, decision;
    acceptances: verdict_id, status, gold_eligible, authority, human_review_id.
    """
    linked = (
        members.join(_once(verdicts, "verdict_id", "v"), F.col("verdict_id") == F.col("v_key"), "left")
        .join(_once(reviews, "review_id", "r"), F.col("human_review_id") == F.col("r_key"), "left")
        .join(_once(acceptances, "verdict_id", "a"), F.col("verdict_id") == F.col("a_key"), "left")
    )
    accepted = (
        (F.col("a_status") == "human_accepted")
        & F.col("a_gold_eligible")
        & (F.col("a_authority") == "human")
        & (F.col("a_human_review_id") == F.col("human_review_id"))
    )
    rules = [
        ("no_verdict", F.col("v_n").isNotNull()),
        ("verdict_twice", F.col("v_n") == 1),
        ("verdict_of_other_episode", F.col("v_episode_id") == F.col("episode_id")),
        ("no_review", F.col("r_n").isNotNull()),
        ("review_twice", F.col("r_n") == 1),
        ("review_of_other_verdict", F.col("r_verdict_id") == F.col("verdict_id")),
        ("no_human_acceptance", (F.col("r_authority") == "human") & (F.col("r_decision") == "accept_for_gold")),
        ("no_gold_decision", F.col("a_n").isNotNull()),
        ("gold_decision_twice", F.col("a_n") == 1),
        ("not_admitted", accepted),
    ]
    faults = [F.when(~F.coalesce(holds, F.lit(False)), name) for name, holds in rules]
    return linked.select(*members.columns, F.coalesce(*faults).alias("problem"))


def order_problems(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Positions (from 1) where the rows' episode differs from the members'; both have position, episode_id."""
    left = rows.select("position", F.col("episode_id").alias("row_episode"))
    right = members.select("position", F.col("episode_id").alias("member_episode"))
    return left.join(right, "position", "full").where(~F.col("row_episode").eqNullSafe(F.col("member_episode")))


def shared_reviews(members: DataFrame) -> DataFrame:
    """Members whose review admits another one too."""
    n = F.count("*").over(Window.partitionBy("human_review_id"))
    return members.withColumn("_n", n).where("_n > 1").drop("_n")


#: HTTP states that may pass, besides those of servers.
TRANSIENT = (408, 409, 425, 429)


def failure(kind: Column, http_status: Column) -> dict[str, Column]:
    """failure_code and disposition of an attempt; ``kind`` is null (done), http, network or another code."""
    passing = http_status.isin(*TRANSIENT) | http_status.between(500, 599)
    code = (
        F.when(kind == "http", F.when(passing, "http_transient").otherwise("http_permanent"))
        .when(kind == "network", "network_delivery_unknown")
        .otherwise(kind)
    )
    disposition = (
        F.when(kind.isNull(), "not_applicable")
        .when(code.isin("http_transient", "network_delivery_unknown"), "manual_retry_candidate")
        .otherwise("do_not_retry")
    )
    return {"failure_code": code, "disposition": disposition}


# -- release files -------------------------------------------------------------------
RELEASE_VERSION = "release-manifest-0.1.0"


class ReleaseError(ValueError):
    pass


def dataset_hash(files: list[dict]) -> str:
    """Hash of the ordered files' paths, bytes and row counts."""
    return digest([{k: f[k] for k in ("relative_path", "sha256", "row_count")} for f in files])


def described_files(spark: SparkSession, root: str, relative: list[str]) -> list[dict]:
    """relative_path, sha256 and row_count of data files, each hashed in a task of its own."""
    if relative != sorted(set(relative)) or any(p.startswith("/") or ".." in p.split("/") for p in relative):
        raise ReleaseError("files must be relative, sorted and each once")
    if not relative:
        raise ReleaseError("a release has at least one file")
    base = root.rstrip("/")
    text = F.decode("content", "ISO-8859-1")
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    files = spark.read.format("binaryFile").load([f"{base}/{p}" for p in relative])
    found = files.select("path", F.sha2("content", 256).alias("sha"), ends.cast("long").alias("n"), text.endswith("\n").alias("whole")).collect()
    by_name = {next(p for p in relative if r.path.endswith(f"/{p}")): r for r in found}
    if bad := [p for p in relative if not by_name[p].whole]:
        raise ReleaseError(f"a file is empty or ends inside a line: {bad[0]}")
    return [{"relative_path": p, "sha256": f"sha256:{by_name[p].sha}", "row_count": by_name[p].n} for p in relative]


def build_manifest(spark: SparkSession, root: str, relative: list[str], members: list[dict]) -> dict:
    """The manifest of a release's files and its members (episode_id, verdict_id, human_review_id), in order."""
    files = described_files(spark, root, relative)
    body = {
        "schema_version": RELEASE_VERSION,
        "dataset_sha256": dataset_hash(files),
        "dataset_row_count": sum(f["row_count"] for f in files),
        "files": files,
        "gold_members": members,
    }
    manifest = {"release_id": stable_id("release", body), **body}
    if faults := manifest_faults(manifest) + dataset_faults(spark, root, manifest):
        raise ReleaseError("; ".join(faults))
    return manifest


def manifest_faults(manifest: dict) -> list[str]:
    """What a release manifest says that does not hold in itself."""
    files, members = manifest["files"], manifest["gold_members"]
    paths, ids, reviews = ([x[k] for x in rows] for rows, k in ((files, "relative_path"), (members, "episode_id"), (members, "human_review_id")))
    rules = (
        (not files or not members, "no_files_or_members"),
        (paths != sorted(set(paths)), "files_not_sorted_or_repeated"),
        (ids != sorted(set(ids)), "members_not_sorted_or_repeated"),
        (len(reviews) != len(set(reviews)), "review_admits_two"),
        (manifest["dataset_row_count"] != sum(f["row_count"] for f in files), "rows_do_not_add_up"),
        (manifest["dataset_row_count"] != len(members), "rows_are_not_members"),
        (manifest["dataset_sha256"] != dataset_hash(files), "dataset_hash"),
        (manifest["release_id"] != stable_id("release", {k: v for k, v in manifest.items() if k != "release_id"}), "identity"),
    )
    return [name for test, name in rules if test]


def write_manifest(manifest: dict, path: str) -> dict:
    """One canonical line in a new file; a file that is there is never replaced."""
    with open(path, "x", encoding="utf-8", newline="") as out:
        out.write(canonical(manifest) + "\n")
    return {"release_id": manifest["release_id"], "path": path}


def read_manifest(path: str) -> dict:
    """The one record of a manifest file, checked in itself."""
    with open(path, "rb") as source:
        lines = source.read().split(b"\n")
    if len(lines) != 2 or lines[1]:
        raise ReleaseError("a release manifest is exactly one line")
    manifest = loads(lines[0])
    if not isinstance(manifest, dict) or (faults := manifest_faults(manifest)):
        raise ReleaseError(f"the manifest does not hold: {faults if isinstance(manifest, dict) else 'no object'}")
    return manifest


def dataset_rows(spark: SparkSession, root: str, manifest: dict) -> DataFrame:
    """(position, episode_id) of the release's rows over its files in order."""
    order = {f["relative_path"]: i for i, f in enumerate(manifest["files"])}
    before, at = {}, 0
    for f in manifest["files"]:
        before[f["relative_path"]] = at
        at += f["row_count"]
    paths = [f"{root.rstrip('/')}/{p}" for p in order]
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("n"), F.get_json_object("value", "$.episode_id").alias("episode_id")
    )
    first = F.lit(None).cast("long")
    for relative, n in before.items():
        first = F.when(F.col("path").endswith(f"/{relative}"), F.lit(n)).otherwise(first)
    inside = F.row_number().over(Window.partitionBy("path").orderBy("n"))
    return lines.select((first + inside).alias("position"), "episode_id")


def dataset_faults(spark: SparkSession, root: str, manifest: dict) -> list[str]:
    """Where the files on disk are not those of the manifest, or their rows not its members in order."""
    try:
        seen = described_files(spark, root, [f["relative_path"] for f in manifest["files"]])
    except ReleaseError as error:
        return [str(error)]
    faults = [f"other_file {a['relative_path']}" for a, b in zip(manifest["files"], seen, strict=True) if a != b]
    if faults:
        return faults
    listed = [(i, m["episode_id"]) for i, m in enumerate(manifest["gold_members"], 1)]
    wrong = order_problems(dataset_rows(spark, root, manifest), spark.createDataFrame(listed, "position long, episode_id string"))
    return [f"other_row {r.position}" for r in wrong.orderBy("position").limit(20).collect()]
