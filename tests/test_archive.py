"""Files kept byte for byte."""

import hashlib
from datetime import datetime

from tideline.sources.archive import archive_files, archived, contents


def test_bytes_are_kept_once_and_lists_stay(spark, tmp_path):
    source, kept = tmp_path / "source", f"{tmp_path}/kept"
    source.mkdir()
    for name, data in (("a.csv", b"id\r\n1\r\n"), ("b.csv", b"\xff\x00raw"), ("c.csv", b"id\r\n1\r\n"), ("empty.csv", b"")):
        (source / name).write_bytes(data)
    first = {r.path.rsplit("/", 1)[1]: r for r in archive_files(spark, str(source), kept, datetime(2025, 1, 1)).collect()}
    assert {n: r.sha256 for n, r in first.items()} == {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in source.iterdir() if f.name != "empty.csv"}
    assert len([p for p in (tmp_path / "kept" / "objects").iterdir() if p.suffix != ".crc"]) == 2
    (source / "a.csv").write_bytes(b"other")
    archive_files(spark, str(source), kept, datetime(2025, 1, 2))
    old = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in contents(spark, kept, "20250101000000").collect()}
    new = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in contents(spark, kept, "20250102000000").collect()}
    assert old == {"a.csv": b"id\r\n1\r\n", "b.csv": b"\xff\x00raw", "c.csv": b"id\r\n1\r\n"}
    assert new == {**old, "a.csv": b"other"} and archived(spark, kept, "20250101000000").count() == 3
