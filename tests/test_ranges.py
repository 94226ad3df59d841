"""Lines of byte ranges against lines of whole files, and files that change under a read."""

import hashlib
import io
import os
import random
import tracemalloc

import pytest

from marlstone.sources import jsonl, ranges


def whole_lines(data):
    out, at = [], 0
    for line in data.splitlines(keepends=True) if b"\r" not in data else [x + b"\n" for x in data.split(b"\n")[:-1]] + [data.split(b"\n")[-1]]:
        if line:
            raw = line[:-1].removesuffix(b"\r") if line.endswith(b"\n") else line
            out.append((at, raw, len(raw), hashlib.sha256(raw).hexdigest()))
        at += len(line)
    return out


@pytest.mark.parametrize("piece_bytes", [1, 3, 64])
def test_every_cut_gives_the_lines_of_the_whole(monkeypatch, tmp_path, piece_bytes):
    monkeypatch.setattr(ranges, "PIECE_BYTES", piece_bytes)
    rng = random.Random(piece_bytes)
    for round_ in range(60):
        data = b"".join(rng.choices([b"a", b"bc", b"\n", b"\n", b"\r\n", b"\r", b"x" * 30], k=rng.randint(0, 25)))
        (tmp_path / "f.jsonl").write_bytes(data)
        want = whole_lines(data)
        for size in (1, 2, 7, 1000):
            reader = ranges.RangesReader({"path": str(tmp_path), "rangebytes": size})
            rows = [r for part in reader.partitions() for r in reader.read(part)]
            assert sum(r[2] for r in rows) == len(data) and rows[-1][5:] == (len(data), "sha256:" + hashlib.sha256(data).hexdigest())
            got = []
            for _, start, length, sha256, n_lines, _, _ in rows:
                own = hashlib.sha256()
                lines = list(ranges.lines_of(io.BytesIO(data), start, length, 10, own))
                assert f"sha256:{own.hexdigest()}" == sha256 and len(lines) == n_lines
                got += lines
            # a line of more than the limit (and a CR) has no bytes, but its length and digest
            assert [(a, s, h) for a, _, s, h in got] == [(a, s, h) for a, _, s, h in want]
            assert all(g[1] == w[1] or g[1] is None and w[2] >= 10 for g, w in zip(got, want))


def test_a_long_line_is_never_one_value(tmp_path):
    """512 MiB of zeros without a line's end: registered and read in pieces."""
    with open(tmp_path / "long.jsonl", "wb") as sparse:
        os.truncate(sparse.fileno(), 512 << 20)
    tracemalloc.start()
    reader = ranges.RangesReader({"path": str(tmp_path)})
    rows = list(reader.read(reader.partitions()[0]))
    with open(tmp_path / "long.jsonl", "rb") as stream:
        lines = list(ranges.lines_of(stream, 0, rows[0][2], 1 << 20, hashlib.sha256()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rows) == 4 and [r[4] for r in rows] == [1, 0, 0, 0] and peak < 64 << 20
    assert [(a, raw, size) for a, raw, size, _ in lines] == [(0, None, 512 << 20)]


def test_what_changes_under_a_read_fails(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"id":1}\n{"id":true}\n' * 50)
    (tmp_path / "_hidden.jsonl").write_bytes(b"{}\n")
    snapshot = jsonl.register(spark, str(tmp_path), "n", "r", 64)
    assert [f["relative_path"] for f in snapshot["files"]] == ["a.jsonl"] and snapshot["record_count"] == 100
    rows = jsonl.ingest(spark, snapshot)
    assert sorted(r.source_native_id for r in rows.collect()) == ["1"] * 50 + ["True"] * 50
    assert jsonl.ingest(spark, snapshot, limit=8).where("code = 'PARSE_RECORD_TOO_LARGE' and raw_record_utf8 is null").count() == 50
    (tmp_path / "a.jsonl").write_bytes(b'{"id":1}\n{"id":null}\n'[:21] * 50)  # as long as before
    with pytest.raises(Exception, match="changed since"):
        rows.collect()
    (tmp_path / "a.jsonl").write_bytes(b"")
    with pytest.raises(Exception, match="changed since"):
        rows.collect()
    (tmp_path / "b.jsonl").write_bytes(b"")
    with pytest.raises(Exception, match="after the registration"):
        jsonl.ingest(spark, snapshot).collect()


def test_no_lines_and_no_files(spark, tmp_path):
    with pytest.raises(ValueError, match="no .jsonl file"):
        jsonl.register(spark, str(tmp_path), "n", "r")
    (tmp_path / "e.jsonl").write_bytes(b"")
    snapshot = jsonl.register(spark, str(tmp_path), "n", "r")
    assert snapshot["record_count"] == 0 and jsonl.ingest(spark, snapshot).count() == 0
