from __future__ import annotations

import io
import json
import tarfile

import pytest

from voxlake.sources import items as I


def test_plan_keeps_the_first_of_repeated_ids(spark):
    got = I.planned_items(spark, ["b", "a"], lambda q, n: ["a", "c", "b"][:n], "query", 3).collect()
    assert [r.identifier for r in got] == ["b", "a", "c"]


def test_files_of_items(spark):
    docs = [("x", json.dumps({"metadata": {"licenseurl": "l"}, "files": [{"name": "a.mp3", "source": "original", "size": "5", "length": "61.5"}, {"name": "b.mp3", "length": "?"}]})), ("y", "{broken"), ("z", "{}")]
    files = I.item_files(spark.createDataFrame(docs, "identifier string, document string"))
    assert [(r.identifier, r.licence, r.name, r.seq) for r in files.collect()] == [("x", "l", "a.mp3", 0), ("x", "l", "b.mp3", 1)]
    assert [r.length for r in I.work_units(files).collect()] == [61.5, None]


def test_downloads_appear_whole(tmp_path):
    target = tmp_path / "d/x.mp3"

    def broken():
        yield b"half"
        raise OSError("gone")

    with pytest.raises(OSError, match="gone"):
        I.download(broken, target)
    assert not target.exists() and not list(target.parent.iterdir())
    assert I.download(lambda: [b"a", b"b"], target).read_bytes() == b"ab"
    assert I.download(broken, target).read_bytes() == b"ab"


def test_archive_and_links(tmp_path):
    with tarfile.open(tmp_path / "a.tar", "w") as t:
        info = tarfile.TarInfo("deep/x.wav")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
    I.unpack(tmp_path / "a.tar", tmp_path / "out")
    rows = [(str(tmp_path / "out/deep/x.wav"), str(tmp_path / "kept/x.wav"))]
    assert (I.publish(rows), I.publish(rows)) == (1, 0) and (tmp_path / "kept/x.wav").read_bytes() == b"abc"


def test_keys(tmp_path):
    (tmp_path / "keys").write_text("﻿k3 # spare\n\nk1\n", encoding="utf-8")
    assert I.api_keys({"A": "k1, k2", "B": ""}, ["A", "B", "C"], [tmp_path / "keys", tmp_path / "none"]) == ["k1", "k2", "k3"]


def test_probe_and_checks(spark):
    error = json.dumps({"error": {"details": [{"violations": [{"quotaId": "XPerDay"}]}, {"retryDelay": "7s"}]}})
    got = I.quota_probe(spark, ["p", "q"], ["m"], lambda k, m: error if k == "p" else None).orderBy("key").collect()
    assert [tuple(r) for r in got] == [(0, "m", False, 7.0, True), (1, "m", True, None, False)]
    checks = I.preflight({"fine": lambda: "v1", "no": lambda: False, "bad": lambda: 1 / 0, "disk": lambda: I.disk_guard("/", 0.0)})
    assert [(n, ok) for n, ok, _ in checks] == [("fine", True), ("no", False), ("bad", False), ("disk", True)]


def test_curves():
    svg = I.curves_svg([("train", 0, 4.0), ("train", 10, 2.0), ("eval", 5, float("nan")), ("eval", 5, 3.0)])
    assert svg.count("<polyline") == 2 and 'points="0.0,0.0 800.0,400.0"' in svg and I.curves_svg([]).startswith("<svg")
