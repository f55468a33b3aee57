"""Copy-on-write snapshots: only touched files are rewritten, readers see one
version, failed and concurrent commits change nothing, old files go."""

import os

import pytest
from pyspark.sql import functions as F

from adlake.operators.frames import upsert
from adlake.sources.snapshots import SnapshotTable

SCHEMA = "client string, id long, v long"


def _table(spark, tmp_path, **kw):
    return SnapshotTable(spark, str(tmp_path / "t"), ["client", "id"], ["client"], **kw)


def _combine(base, delta):
    return upsert(delta.limit(0) if base is None else base, delta, ["client", "id"], [F.col("v").desc()])


def _rows(df):
    return sorted((tuple(r) for r in df.select("client", "id", "v").collect()), key=str)


def _first(spark):
    return spark.createDataFrame([(c, i, 0) for c in ("a", "b", None) for i in range(100)], SCHEMA)


def test_a_batch_rewrites_the_files_that_may_hold_its_keys(spark, tmp_path):
    t = _table(spark, tmp_path, file_rows=10)
    t.merge(_first(spark), _combine)
    before = {r.file: r for r in t.files().collect()}
    assert len(before) == 30 and sum(r.n_rows for r in before.values()) == 300
    t.merge(spark.createDataFrame([("a", 42, 5), (None, 7, 6), ("c", 1, 1), ("b", 1000, 2)], SCHEMA), _combine)
    after = {r.file for r in t.files().collect()}
    gone = set(before) - after
    # One file of a and one of the null client; new keys touch nothing.
    assert len(gone) == 2 and {(before[f].low["client"], before[f].low["id"] // 10) for f in gone} == {("a", 4), (None, 0)}
    want = {(c, i): 0 for c in ("a", "b", None) for i in range(100)} | {("a", 42): 5, (None, 7): 6, ("c", 1): 1, ("b", 1000): 2}
    assert _rows(t.read()) == sorted(((c, i, v) for (c, i), v in want.items()), key=str)


def test_a_reader_keeps_its_version(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.merge(_first(spark), _combine)
    open_reader = t.read()
    t.merge(spark.createDataFrame([("a", 1, 9)], SCHEMA), _combine)
    assert ("a", 1, 0) in _rows(open_reader) and ("a", 1, 9) not in _rows(open_reader)
    assert ("a", 1, 9) in _rows(t.read()) and ("a", 1, 0) not in _rows(t.read())
    assert _rows(t.read(t.versions()[0])) == _rows(open_reader)


def test_a_failed_commit_changes_nothing(spark, tmp_path, monkeypatch):
    t = _table(spark, tmp_path)
    t.merge(_first(spark), _combine)
    want = _rows(t.read())
    with pytest.raises(Exception, match="no"):
        t.merge(spark.createDataFrame([("a", 1, 9)], SCHEMA), lambda b, d: d.withColumn("v", F.raise_error(F.lit("no")).cast("long")))
    assert _rows(t.read()) == want
    # Between the written files and the rename, readers still find the old version.
    seen = []
    real = t._fs

    class Slow:
        def __getattr__(self, name):
            return getattr(real, name)

        def rename(self, a, b):
            seen.append(_rows(SnapshotTable(spark, t.root, t.keys, ["client"]).read()))
            return real.rename(a, b)

    t._fs = Slow()
    t.merge(spark.createDataFrame([("a", 1, 9)], SCHEMA), _combine)
    assert seen == [want] and ("a", 1, 9) in _rows(t.read())


def test_a_second_writer_of_one_version_fails(spark, tmp_path):
    t, other = _table(spark, tmp_path), _table(spark, tmp_path)
    t.merge(_first(spark), _combine)

    def meanwhile(base, delta):
        other.merge(spark.createDataFrame([("z", 1, 1)], SCHEMA), _combine)
        return _combine(base, delta)

    # Its files were looked up before the other commit.
    with pytest.raises(RuntimeError, match="another writer"):
        t.merge(spark.createDataFrame([("a", 1, 9)], SCHEMA), meanwhile)
    assert ("z", 1, 1) in _rows(t.read()) and ("a", 1, 9) not in _rows(t.read())


def test_old_files_are_cleaned_and_replays_change_nothing(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.merge(_first(spark), _combine)
    delta = spark.createDataFrame([("a", 1, 9)], SCHEMA)
    for _ in range(4):
        t.merge(delta, _combine)
    assert len(t.versions()) == 2
    named = {r.file for v in t.versions() for r in t.files(v).collect()}
    there = {os.path.relpath(os.path.join(d, f), t.root) for d, _, fs in os.walk(f"{t.root}/data") for f in fs if f.endswith(".parquet")}
    assert there == named
    assert len(_rows(t.read())) == 300 and ("a", 1, 9) in _rows(t.read())
    t.replace(spark.createDataFrame([("q", 1, 1)], SCHEMA))
    assert _rows(t.read()) == [("q", 1, 1)]
    t.replace(spark.createDataFrame([], SCHEMA))
    assert t.read() is None and t.touched(delta) == []
