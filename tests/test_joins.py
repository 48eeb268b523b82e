from __future__ import annotations

import pytest

from tablegate.operators import joins
from tablegate.operators.joins import anti_join, semi_join, small
from tablegate.session import materialize, scratch_path, shared_dir, staged


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")


def values(df):
    return sorted(r.v for r in df.collect())


@pytest.mark.parametrize("limit", [10**6, 0])
def test_matching(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", limit)
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert values(anti_join(rows, keys, ["k"])) == ["c"]
    assert values(semi_join(rows, keys, ["k"])) == ["a", "b", "d"]


def test_only_a_measured_side_is_broadcast(spark, rows, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.createDataFrame([(1,)], "k int")
        assert "BroadcastHashJoin" in plan(semi_join(rows, keys, ["k"]))
        assert "BroadcastHashJoin" in plan(rows.join(small(keys), "k"))
        monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
        assert "SortMergeJoin" in plan(semi_join(rows, keys, ["k"]))
        assert "SortMergeJoin" in plan(rows.join(small(keys), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_keys(spark, rows):
    none = spark.createDataFrame([], "k int")
    assert "Join" not in plan(anti_join(rows, none, ["k"]))
    assert semi_join(rows, none, ["k"]).count() == 0


def test_shared_folder(spark, rows):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert materialize(rows).count() == 4
    assert "Scan ExistingRDD" in plan(materialize(rows))
    with staged(rows, "rows") as kept:
        path = kept.inputFiles()[0]
        assert folder in path and kept.count() == 4
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        spark.read.parquet(path).count()
