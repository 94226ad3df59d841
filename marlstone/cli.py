"""Command line: sources, ingestion, audits, selection, releases, packages.

    python -m marlstone.cli <command> ...

Exit codes: 0 done, 1 a check failed, 2 a file or a setting cannot be used.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _spark() -> SparkSession:
    from . import session

    spark = SparkSession.getActiveSession() or session.local_session()
    session.ship(spark)
    return spark


def _say(value: object) -> None:
    print(json.dumps(value, ensure_ascii=False, sort_keys=True, default=str))


def _rows(df: DataFrame, limit: int) -> None:
    for row in df.limit(limit).collect():
        _say(row.asDict(recursive=True))


def _fields(text: str) -> list[str]:
    return [part for part in text.split(",") if part]


def source_register(a: argparse.Namespace) -> None:
    from .sources import jsonl

    snapshot = jsonl.register(_spark(), a.root, a.namespace, a.revision)
    if a.out:
        Path(a.out).write_text(json.dumps(snapshot, sort_keys=True) + "\n")
    _say(snapshot)


def source_validate(a: argparse.Namespace) -> None:
    from .sources import jsonl

    jsonl.verify(_spark(), json.loads(Path(a.snapshot).read_text()))
    _say({"snapshot": "unchanged"})


def source_array(a: argparse.Namespace) -> None:
    from .sources import jsonl

    _say(jsonl.array_to_jsonl(_spark(), a.input, a.out))


def ingest(a: argparse.Namespace) -> None:
    from .sources import jsonl

    spark, snapshot = _spark(), json.loads(Path(a.snapshot).read_text())
    bronze = jsonl.ingest(spark, snapshot, a.max_record_bytes, a.id_field, a.cap)
    bronze.write.parquet(a.out)
    jsonl.verify(spark, snapshot)
    _rows(jsonl.accounting(spark.read.parquet(a.out)), 1)


def registry_build(a: argparse.Namespace) -> None:
    from .operators import tools

    made = tools.registry(_spark().read.parquet(a.input), a.column)
    made.write.parquet(a.out)
    _say({"out": a.out})


def canonicalize(a: argparse.Namespace) -> None:
    from .operators import tools

    rows = _spark().read.parquet(a.input)
    made = rows.select("*", tools.canonical_episodes(F.col(a.column), a.run_event_id).alias("_made")).select("*", "_made.*").drop("_made")
    made.write.parquet(a.out)
    _say({"out": a.out})


def inspect(a: argparse.Namespace) -> None:
    from .operators import histories

    rows = _spark().read.parquet(a.input)
    found = histories.lookup({"rows": (rows, _fields(a.keys))}, a.value)
    if found is None:
        raise ValueError(f"nothing has the id {a.value}")
    _rows(found, 1)


def stats(a: argparse.Namespace) -> None:
    rows = _spark().read.parquet(a.input)
    _rows(rows.groupBy(*_fields(a.by)).agg(F.count("*").alias("n_rows")), a.limit)


def audit_duplicates(a: argparse.Namespace) -> None:
    from .operators import audit

    rows = _spark().read.parquet(a.input)
    audit.duplicate_members(rows, _fields(a.keys), a.member).write.parquet(a.out)
    _say({"out": a.out})


def audit_near(a: argparse.Namespace) -> None:
    from .operators import similarity

    rows = _spark().read.parquet(a.input)
    similarity.candidates(rows, a.member, a.text, a.n, a.threshold).write.parquet(a.out)
    _say({"out": a.out})


def diagnostics(a: argparse.Namespace) -> None:
    from .functions.diagnostics import CATALOGUE

    for code, stage, severity in CATALOGUE:
        _say({"code": code, "stage": stage, "severity": severity, "retryable": False})


def select_freeze(a: argparse.Namespace) -> None:
    from .operators import selection

    queue = _spark().read.parquet(a.input)
    selection.frozen(queue, a.member, a.n).write.parquet(a.out)
    _say({"out": a.out})


def review_prepare(a: argparse.Namespace) -> None:
    from .operators import review

    spark = _spark()
    made, bad = review.tasks(spark.read.parquet(a.quarantines), spark.read.parquet(a.conflicts))
    if clash := [r.evidence_id for r in bad.limit(20).collect()]:
        raise ValueError(f"evidence that contradicts itself: {', '.join(clash)}")
    made.write.parquet(a.out)
    _say({"out": a.out})


def release_build(a: argparse.Namespace) -> None:
    from .operators import release

    members = json.loads(Path(a.members).read_text())
    _say(release.write_manifest(release.build_manifest(_spark(), a.root, _fields(a.files), members), a.out))


def release_validate(a: argparse.Namespace) -> None:
    from .operators import release

    faults = release.dataset_faults(_spark(), a.root, release.read_manifest(a.manifest))
    for fault in faults:
        _say({"fault": fault})
    if faults:
        raise ValueError("the release does not hold")
    _say({"release": "valid"})


def automation_status(a: argparse.Namespace) -> None:
    from .sources import publish

    stages = dict(part.split("=", 1) for part in a.stage)
    _rows(publish.stage_states(_spark(), stages), 1000)


def export(a: argparse.Namespace) -> None:
    from .sources import publish

    lines = publish.conversation_lines(_spark().read.parquet(a.input), a.by)
    _say(publish.publish_shards(lines, a.out, "conversations", "conversation-0.1.0", "export", [a.by]))


def schema_export(a: argparse.Namespace) -> None:
    from .sources import publish

    _say(publish.schema_of(_spark().read.parquet(a.input), a.title))


def query(a: argparse.Namespace) -> None:
    import importlib

    found = importlib.import_module("__spark_entry__").queries()
    if a.name not in found:
        raise ValueError(f"no query {a.name}; there are {', '.join(sorted(found))}")
    out = found[a.name](_spark(), a.tables)
    if a.out:
        out.write.parquet(a.out)
        _say({"out": a.out})
    else:
        _rows(out, a.limit)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marlstone")
    groups = top.add_subparsers(dest="group", required=True)
    made: dict[str, argparse._SubParsersAction] = {}

    def command(path: str, run: Callable[[argparse.Namespace], None], *required: str, **optional: object) -> None:
        *group, name = path.split()
        if group and group[0] not in made:
            made[group[0]] = groups.add_parser(group[0]).add_subparsers(dest="command", required=True)
        one = (made[group[0]] if group else groups).add_parser(name)
        for option in required:
            one.add_argument(f"--{option.replace('_', '-')}", required=True, dest=option)
        for option, default in optional.items():
            kind = type(default) if isinstance(default, int | float | str) else str
            one.add_argument(f"--{option.replace('_', '-')}", default=default, type=kind, dest=option)
        one.set_defaults(run=run)

    command("source register", source_register, "root", "namespace", "revision", out=None)
    command("source validate", source_validate, "snapshot")
    command("source json-array-to-jsonl", source_array, "input", "out")
    command("ingest", ingest, "snapshot", "out", max_record_bytes=8 << 20, id_field="id", cap=None)
    command("registry build", registry_build, "input", "out", column="tool")
    command("canonicalize", canonicalize, "input", "out", column="record", run_event_id="evt_cli")
    command("inspect", inspect, "input", "value", keys="episode_id,source_occurrence_id,tool_id")
    command("stats", stats, "input", by="action", limit=1000)
    command("audit duplicates", audit_duplicates, "input", "out", keys="context_fp,behavior_fp", member="episode_id")
    command("audit near-duplicates", audit_near, "input", "out", member="doc_id", text="text", n=3, threshold=0.82)
    command("diagnostics", diagnostics)
    command("select freeze", select_freeze, "input", "out", member="episode_id", n=400)
    command("review prepare", review_prepare, "quarantines", "conflicts", "out")
    command("release build", release_build, "root", "files", "members", "out")
    command("release validate", release_validate, "root", "manifest")
    command("export conversations", export, "input", "out", by="conv_id")
    command("schema export", schema_export, "input", title="row")
    command("query", query, "name", "tables", out=None, limit=20)
    status = groups.add_parser("status")
    status.add_argument("stage", nargs="+", help="name=folder")
    status.set_defaults(run=automation_status)
    return top


def main(args: list[str] | None = None) -> int:
    try:
        a = parser().parse_args(args)
    except SystemExit as stop:
        return 2 if stop.code else 0
    if getattr(a, "cap", None) is not None:
        a.cap = int(a.cap)
    try:
        a.run(a)
    except OSError as error:
        print(error, file=sys.stderr)
        return 2
    except Exception as error:  # noqa: BLE001  a failed check is an exit code and one line here
        print(str(error).splitlines()[0], file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
