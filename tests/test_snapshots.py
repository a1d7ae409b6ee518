"""Snapshots: versions, stopped writers, two writers at once."""

import pytest

from offerloom.sources import snapshots


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "id int, category string")


def got(spark, path, like, version=None):
    return sorted((r.id, r.category, r.version) for r in snapshots.read(spark, path, like, version).collect())


def test_versions(spark, tmp_path):
    path, first = str(tmp_path), rows_of(spark, (1, "a"), (2, "b"), (3, "x"), (4, None))
    assert got(spark, path, first) == [] and snapshots.versions(spark, path) == {}
    assert snapshots.write(first, ["a", "b", "c"], path) == {"a": 0, "b": 0, "c": 0}
    assert snapshots.write(rows_of(spark, (5, "a")), ["a", "d"], path) == {"a": 1, "d": 0}
    assert got(spark, path, first) == [(2, "b", 0), (5, "a", 1)]
    assert got(spark, path, first, {"a": 0}) == [(1, "a", 0)]
    assert snapshots.versions(spark, path) == {"a": 1, "b": 0, "c": 0, "d": 0}


def test_too_many_missing(spark, tmp_path):
    path, rows = str(tmp_path), rows_of(spark, (1, "a"))
    with pytest.raises(ValueError):
        snapshots.write(rows, list("abcdef"), path)
    assert snapshots.versions(spark, path) == {} and snapshots.sweep(spark, path) == 1
    assert set(snapshots.write(rows, list("abcde"), path)) == set("abcde")  # four of five is just not too many


def test_a_stopped_write_leaves_no_version(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path), rows_of(spark, (1, "a"))
    snapshots.write(rows, ["a"], path)

    def stopped(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "committed", stopped)
        with pytest.raises(RuntimeError):
            snapshots.write(rows_of(spark, (2, "a")), ["a"], path)
    assert got(spark, path, rows) == [(1, "a", 0)]
    (tmp_path / "manifests" / f"{1:012}").write_text('{"folder": "x", "vers')  # stopped while the manifest was written
    assert got(spark, path, rows) == [(1, "a", 0)]
    assert snapshots.write(rows_of(spark, (3, "a")), ["a"], path) == {"a": 1} and got(spark, path, rows) == [(3, "a", 1)]
    assert snapshots.sweep(spark, path) == 1 and got(spark, path, rows) == [(3, "a", 1)]


def test_two_writers_share_no_version(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path), rows_of(spark, (1, "a"))
    slow = snapshots.staged(rows_of(spark, (2, "a"), (3, "b")), path)
    looked, real = [], snapshots.manifests

    def late(*a):
        """The other writer commits after this one has looked."""
        out = real(*a)
        if not looked:
            looked.append(1)
            snapshots.write(rows, ["a"], path)
        return out

    monkeypatch.setattr(snapshots, "manifests", late)
    assert snapshots.committed(spark, path, slow, ["a", "b"]) == {"a": 1, "b": 0}
    assert got(spark, path, rows) == [(2, "a", 1), (3, "b", 0)] and got(spark, path, rows, {"a": 0}) == [(1, "a", 0)]
