"""Stopping a writer at every step of a merge: no row is lost, and none is there twice."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tablegate.operators.merge import incremental_merge, upsert
from tablegate.sources import publish
from tablegate.sources.publish import (
    Folder,
    last_schema,
    newest_partition,
    partition_values,
    read_table,
    recover,
    replace_partitions,
    schema_history,
)

SCHEMA = "k int, v string, h string, day date"
DAYS = [date(2025, 3, d) for d in (1, 2, 3)]


class Stopped(Exception):
    pass


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def stop_at(monkeypatch, method, call):
    """Let a folder's method die at its n-th call, as a killed driver would."""
    kept, calls = getattr(Folder, method), []

    def counting(self, *args):
        calls.append(args)
        if len(calls) == call:
            raise Stopped
        return kept(self, *args)

    monkeypatch.setattr(Folder, method, counting)


def rows_of(df):
    return sorted((r.k, r.v, r.day) for r in df.collect())


BEFORE = [(i, "old", "x", DAYS[i % 3]) for i in range(9)]
SOURCE = [(i, "new", "y", DAYS[i % 3]) for i in range(6, 12)]
OLD = sorted((k, v, d) for k, v, _, d in BEFORE)
NEW = sorted((k, "new" if k >= 6 else "old", DAYS[k % 3]) for k in range(12))


# The manifest counts from the second move on (the first puts it in place); partitions are
# deleted and moved one by one after it.
@pytest.mark.parametrize(
    ("method", "call", "expected"),
    [("write", 2, OLD), ("move", 2, OLD), ("delete", 1, NEW), ("move", 3, NEW), ("delete", 2, NEW),
     ("move", 4, NEW), ("delete", 3, NEW), ("move", 5, NEW), ("delete", 4, NEW), ("delete", 5, NEW)],
)
def test_a_stopped_merge_loses_no_row(spark, tmp_path, monkeypatch, method, call, expected):
    path = str(tmp_path / "t")
    upsert(spark, path, frame(spark, *BEFORE), ["k"], "day", "h")
    wider = frame(spark, *SOURCE).withColumn("extra", F.lit(1))
    with monkeypatch.context() as patch:
        stop_at(patch, method, call)
        with pytest.raises(Stopped):
            upsert(spark, path, wider, ["k"], "day", "h")
    assert rows_of(read_table(spark, path)) == expected
    # The next writer finishes or drops the version first, whatever it has to do itself.
    again = upsert(spark, path, wider, ["k"], "day", "h").agg(F.sum("rows_updated"), F.sum("rows_inserted")).first()
    assert tuple(again) == ((0, 0) if expected == NEW else (3, 3))
    assert rows_of(read_table(spark, path)) == NEW
    assert rows_of(spark.read.schema(SCHEMA).parquet(path)) == NEW
    assert not (tmp_path / "t" / "_pending").exists()


def test_stopped_first_load(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as patch:
        stop_at(patch, "move", 3)
        with pytest.raises(Stopped):
            upsert(spark, path, frame(spark, *BEFORE), ["k"], "day", "h")
    assert rows_of(read_table(spark, path)) == OLD
    recover(spark, path)
    assert rows_of(spark.read.schema(SCHEMA).parquet(path)) == OLD


def test_a_move_that_was_copied_but_not_removed(spark, tmp_path, monkeypatch):
    """Stores without a rename copy and then delete; what is there already is not lost."""
    import shutil

    path = tmp_path / "t"
    upsert(spark, str(path), frame(spark, *BEFORE), ["k"], "day", "h")

    def copied(self, source, target):
        if "_schema" in target or target.endswith("manifest.json"):
            return kept(self, source, target)
        shutil.copytree(path / source, path / target)
        for file in (path / source).iterdir():
            file.unlink()
            break
        raise Stopped

    kept = Folder.move
    with monkeypatch.context() as patch:
        patch.setattr(Folder, "move", copied)
        with pytest.raises(Stopped):
            upsert(spark, str(path), frame(spark, *SOURCE), ["k"], "day", "h")
    assert rows_of(read_table(spark, str(path))) == NEW
    recover(spark, str(path))
    assert rows_of(spark.read.schema(SCHEMA).parquet(str(path))) == NEW


def test_partition_names(spark, tmp_path):
    """Odd and missing partition values survive the manifest and the reader's filter."""
    path = str(tmp_path / "t")
    rows = [(i, v) for i, v in enumerate(["a b", "x=y", "50%", "ü/ö", None, "plain"])]
    table = spark.createDataFrame(rows, "k int, p string")
    replace_partitions(table, path, ["p"])
    stop = pytest.MonkeyPatch()
    with stop.context() as patch:
        stop_at(patch, "move", 4)
        with pytest.raises(Stopped):
            replace_partitions(table.withColumn("k", F.col("k") + 100), path, ["p"])
    got = sorted((r.k, r.p or "") for r in read_table(spark, path, "k int, p string").collect())
    assert got == sorted((k + 100, p or "") for k, p in rows)
    assert partition_values("a=50%25/b=__HIVE_DEFAULT_PARTITION__") == {"a": "50%", "b": None}


def test_schema_file(spark, tmp_path):
    path = str(tmp_path / "t")
    counts = incremental_merge(spark, path, frame(spark, *BEFORE), ["k"], "day")
    assert counts == {"rows_inserted": 9, "rows_updated": 0, "rows_unchanged": 0, "rows_kept": 0}
    wider = frame(spark, *SOURCE).withColumn("extra", F.col("k") * 2)
    counts = incremental_merge(spark, path, wider, ["k"], "day")
    assert counts == {"rows_inserted": 3, "rows_updated": 3, "rows_unchanged": 0, "rows_kept": 6}
    narrow = frame(spark, (1, "narrow", "z", DAYS[1]))
    incremental_merge(spark, path, narrow, ["k"], "day")
    history = schema_history(spark, path)
    assert [s.names for s in history] == [["k", "v", "h", "day"], ["k", "v", "h", "day", "extra"]]
    assert last_schema(spark, path) == history[-1]
    found = {r.k: (r.v, r.extra) for r in read_table(spark, path).collect()}
    assert found[1] == ("narrow", None) and found[8] == ("new", 16) and len(found) == 12


def test_reading_by_the_schema_file_needs_no_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental_merge(spark, path, frame(spark, *BEFORE), ["k"], "day")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reading", "")
    table = read_table(spark, path)
    assert table.columns and list(tracker.getJobIdsForGroup("reading")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_merge_reads_its_target_once(spark, tmp_path, monkeypatch):
    from tablegate.operators import merge

    path, writes = str(tmp_path / "t"), []
    incremental_merge(spark, path, frame(spark, *BEFORE), ["k"], "day")
    kept = merge.merge_rows
    monkeypatch.setattr(merge, "merge_rows", lambda *args: writes.append(1) or kept(*args))
    incremental_merge(spark, path, frame(spark, *SOURCE), ["k"], "day")
    assert writes == [1]


def test_newest_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    assert newest_partition(spark, path, "day") is None
    replace_partitions(frame(spark, *BEFORE, (99, "v", "h", None)), path, ["day"])
    assert newest_partition(spark, path, "day") == "2025-03-03"


def test_nothing_to_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(frame(spark), path, ["day"])
    assert read_table(spark, path, SCHEMA) is None or read_table(spark, path, SCHEMA).count() == 0
    assert publish.schema_history(spark, path) == []
