"""The record store against plain dictionaries."""

import random

import pytest

from batchledger.session import scratch_path
from batchledger.sinks import commits, store

FINAL = {"COMPLETED", "KILLED", "FAILED", "CANCELLED"}
STATES = [*sorted(FINAL), "RUNNING", "PENDING", "odd", None]


def table(spark, rows):
    return spark.createDataFrame([(k[0], k[1], s) for k, s in rows.items()], "list_id STRING, job_id BIGINT, state STRING")


def held(df):
    rows = [((r.list_id, r.job_id), r.state) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_changes_against_a_dictionary(spark):
    path, rng, want = scratch_path(spark, "t"), random.Random(3), {}
    draw = lambda: {(rng.choice("ab"), rng.randrange(30)): rng.choice(STATES) for _ in range(15)}
    for number in range(1, 6):
        rows = draw()
        if number % 2:
            assert store.add_records(spark, path, table(spark, rows)) == number
            want = rows | want
        else:
            assert store.refresh_store(spark, path, table(spark, rows)) == number
            want |= {k: s for k, s in rows.items() if k in want and want[k] not in FINAL}
        assert held(store.read_store(spark, path)) == want
        assert held(store.read_store(spark, path, final=True)) == {k: s for k, s in want.items() if s in FINAL}
    assert store.refresh_store(spark, path, table(spark, {})) == 6
    assert held(store.read_store(spark, path)) == want


def test_a_refresh_reads_no_final_record(spark):
    path = scratch_path(spark, "t")
    with pytest.raises(ValueError, match="no records"):
        store.read_store(spark, path)
    store.add_records(spark, path, table(spark, {}))
    store.add_records(spark, path, table(spark, {("a", 1): "COMPLETED", ("a", 2): "RUNNING"}))
    files = store.refreshed(spark, path, table(spark, {("a", 2): "FAILED"})).inputFiles()
    assert files and all("/batch=2/kind=open/" in f for f in files)


def test_two_writers_and_one_that_died(spark, monkeypatch):
    path = scratch_path(spark, "t")
    store.add_records(spark, path, table(spark, {("a", 1): "RUNNING", ("a", 2): "RUNNING"}))
    publish, create = commits._Folder.publish, commits._Folder.create

    def overtaken(self, *names):  # another writer is faster
        monkeypatch.setattr(commits._Folder, "create", create)
        store.refresh_store(spark, path, table(spark, {("a", 1): "FAILED"}))
        return create(self, *names)

    monkeypatch.setattr(commits._Folder, "create", overtaken)
    with pytest.raises(ValueError, match="commit 2 is taken"):
        store.refresh_store(spark, path, table(spark, {("a", 2): "KILLED"}))
    assert held(store.read_store(spark, path)) == {("a", 1): "FAILED", ("a", 2): "RUNNING"}

    def dies(self, name, text):
        if name.startswith("_tokens/"):
            raise OSError("died")
        return create(self, name, text)

    for method, broken in (("create", dies), ("publish", lambda *_: (_ for _ in ()).throw(OSError("died")))):
        monkeypatch.setattr(commits._Folder, method, broken)
        with pytest.raises(OSError, match="died"):
            store.refresh_store(spark, path, table(spark, {("a", 2): "KILLED"}), token="x")
        monkeypatch.setattr(commits._Folder, "create", create)
        monkeypatch.setattr(commits._Folder, "publish", publish)
        assert held(store.read_store(spark, path)) == {("a", 1): "FAILED", ("a", 2): "RUNNING"}
        with pytest.raises(ValueError, match="commit 3 is taken"):
            store.refresh_store(spark, path, table(spark, {("a", 2): "FAILED"}))
    for _ in range(2):  # done again, and once more
        assert store.refresh_store(spark, path, table(spark, {("a", 2): "KILLED"}), token="x") == 3
    assert held(store.read_store(spark, path)) == {("a", 1): "FAILED", ("a", 2): "KILLED"}
