"""Ranged header reads: bytes per file bounded, huge and empty files."""

import os

import pytest

from vqaspark.operators.prepare import validate_images
from vqaspark.sources import files, headers


def _write(root, name, data, size=None):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
        if size:
            f.truncate(size)                    # sparse: takes no disk


def test_headers_of_many_files(spark, tmp_path):
    root = str(tmp_path)
    for i in range(40):
        _write(root, f"d{i % 3}/p{i:02d}.jpg", b"\xff\xd8\xff" + bytes(30) if i % 2 else b"<html>" * 9)
    _write(root, "big/huge.jpg", b"GIF89a", size=(2 << 30) + 5)
    _write(root, "empty.jpg", b"")
    _write(root, "note.txt", b"GIF89a")
    _write(root, "_hidden/x.jpg", b"GIF89a")
    df = headers.read_headers(spark, root, "*.jpg", files_per_partition=10)
    assert df.rdd.getNumPartitions() == 5
    rows = {os.path.basename(r.path): r for r in validate_images(files.image_listing(spark, root, with_header=True), header_only=True).collect()}
    assert len(rows) == 42 and rows["huge.jpg"].image_valid and rows["huge.jpg"].length == (2 << 30) + 5
    assert rows["huge.jpg"].image_format == "gif" and not rows["empty.jpg"].image_valid
    assert [rows[f"p{i:02d}.jpg"].image_valid for i in range(40)] == [i % 2 == 1 for i in range(40)]
    assert max(len(r.header) for r in df.collect()) == 16
    assert {r.path for r in df.collect()} >= {r.path for r in files.image_listing(spark, root + "/d0").collect()}


def test_one_folder_only_and_errors(spark, tmp_path):
    _write(str(tmp_path), "a.jpg", b"GIF89a")
    _write(str(tmp_path), "in/b.jpg", b"GIF89a")
    assert headers.read_headers(spark, str(tmp_path), recursive=False).count() == 1
    assert headers.read_headers(spark, "file://" + str(tmp_path)).count() == 2
    with pytest.raises(Exception):
        headers.read_headers(spark, str(tmp_path / "nowhere")).count()
    with pytest.raises(ValueError):
        headers.file_system("viewfs://cluster/data")


def test_bytes_read_per_file(spark, tmp_path, monkeypatch):
    from pyarrow import fs
    _write(str(tmp_path), "a.jpg", b"GIF89a", size=1 << 20)
    asked = []

    class Recorded:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()

        def read_at(self, n, offset):
            asked.append((n, offset))
            return self.f.read_at(n, offset)

    class System:
        def get_file_info(self, s):
            return fs.LocalFileSystem().get_file_info(s)

        def open_input_file(self, path):
            return Recorded(fs.LocalFileSystem().open_input_file(path))

    monkeypatch.setattr(headers, "file_system", lambda root: (System(), root, "file:"))
    reader = headers.HeaderReader({"path": str(tmp_path)})
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert asked == [(16, 0)] and rows[0][3] == b"GIF89a" + bytes(10)
