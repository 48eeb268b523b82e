from __future__ import annotations

from datetime import date, datetime

import pytest

from tablegate.operators import merge
from tablegate.operators.dedupe import dedupe_latest
from tablegate.operators.merge import incremental_merge, merge_counts, merge_rows, upsert
from tablegate.session import read_if_exists

SCHEMA = "k int, day date, v string, h string"
D1, D2, D3 = date(2025, 3, 1), date(2025, 3, 2), date(2025, 3, 3)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counts(df):
    row = merge_counts(df.withColumnRenamed("_action", "_action")).first()
    return row.rows_inserted, row.rows_updated, row.rows_unchanged, row.rows_kept


def totals(df):
    rows = df.collect()
    return sum(r.rows_inserted for r in rows), sum(r.rows_updated for r in rows)


def test_dedupe_latest(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (2, 1, "e")], "k int, t int, v string"
    )
    rows = dedupe_latest(df, ["k"], ["t"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 7, "c"), (2, 1, "e")]


def test_dedupe_trims_before_the_shuffle(spark):
    text = plan(dedupe_latest(frame(spark), ["k"], ["day"]))
    assert "row_number(), 1, Partial" in text
    assert text.index("Exchange") < text.index("row_number(), 1, Partial")


def test_merge_actions(spark):
    target = frame(spark, (1, D1, "a", "x"), (2, D1, "b", "x"), (3, D1, "c", "x"), (4, D1, "d", None))
    source = frame(spark, (2, D1, "B", "y"), (3, D1, "C", "x"), (4, D1, "D", "y"), (5, D1, "E", "y"))
    merged = merge_rows(target, source, ["k"], "h")
    assert {r.k: (r.v, r.h, r["_action"]) for r in merged.collect()} == {
        1: ("a", "x", "keep"),
        2: ("B", "y", "update"),
        3: ("c", "x", "unchanged"),
        4: ("d", None, "unchanged"),  # a null guard is no difference
        5: ("E", "y", "insert"),
    }
    assert counts(merged) == (1, 1, 2, 1)
    assert counts(merge_rows(target, source, ["k"])) == (1, 3, 0, 1)


def test_merge_updates_every_copy_in_the_target(spark):
    target = frame(spark, (1, D1, "a", "x"), (1, D1, "b", "x"))
    merged = merge_rows(target, frame(spark, (1, D1, "N", "y")), ["k"], "h")
    assert [(r.v, r["_action"]) for r in merged.collect()] == [("N", "update")] * 2


def test_merge_appends_new_columns(spark):
    target = frame(spark, (1, D1, "a", "x"), (2, D1, "b", "x"))
    source = spark.createDataFrame([(2, D1, 7), (3, D1, 8)], "k int, day date, extra int")
    rows = {r.k: r for r in merge_rows(target, source, ["k"]).collect()}
    assert (rows[1].extra, rows[2].extra, rows[3].extra) == (None, 7, 8)
    assert (rows[2].v, rows[3].v) == ("b", None)  # a column the source lacks is kept


def test_merge_has_no_full_outer_or_cross_join(spark):
    text = plan(merge_rows(frame(spark), frame(spark), ["k"], "h"))
    for kind in ("FullOuter", "NestedLoop", "CartesianProduct"):
        assert kind not in text


def test_counting_reads_keys_and_guard_only(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, (1, D1, "a", "x")).write.parquet(path)
    target = spark.read.parquet(path)
    text = merge_counts(merge_rows(target, target, ["k"], "h"), ["day"])
    schemas = [line for line in text._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert schemas and all("v:string" not in line for line in schemas)


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = frame(spark, (1, D1, "a", "x"), (2, D2, "b", "x"), (2, D2, "b0", "w"))
    assert totals(upsert(spark, path, first, ["k"], "day", "h", latest_by=["h"])) == (2, 0)
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "raw").rglob("*.parquet")}
    assert totals(upsert(spark, path, first, ["k"], "day", "h", latest_by=["h"])) == (0, 0)
    assert stamps == {p: p.stat().st_mtime_ns for p in (tmp_path / "raw").rglob("*.parquet")}

    second = frame(spark, (2, D2, "B", "y"), (3, D2, "c", "y"), (4, D3, "d", "y"))
    assert totals(upsert(spark, path, second, ["k"], "day", "h")) == (2, 1)
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {1: "a", 2: "B", 3: "c", 4: "d"}
    untouched = list((tmp_path / "raw" / "day=2025-03-01").glob("*.parquet"))
    assert [stamps[p] for p in untouched] == [p.stat().st_mtime_ns for p in untouched]


@pytest.mark.parametrize("listed", [1000, 1])
def test_upsert_keeps_rows_without_a_partition_value(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr("tablegate.operators.merge._LISTED_PARTITIONS", listed)
    path = str(tmp_path / "t")
    rows = frame(spark, (1, None, "a", "x"), (2, D1, "b", "x"), (3, D2, "c", "x"))
    assert totals(upsert(spark, path, rows, ["k"], "day", "h")) == (3, 0)
    assert totals(upsert(spark, path, rows, ["k"], "day", "h")) == (0, 0)
    again = frame(spark, (1, None, "A", "y"), (2, D1, "B", "y"))
    assert totals(upsert(spark, path, again, ["k"], "day", "h")) == (0, 2)
    stored = spark.read.schema(SCHEMA).parquet(path)
    assert {r.k: r.v for r in stored.collect()} == {1: "A", 2: "B", 3: "c"}


def test_upsert_counts_per_group(spark, tmp_path):
    rows = frame(spark, (1, D1, "a", "x"), (2, D2, "a", "x"), (3, D2, "b", "x"))
    found = upsert(spark, str(tmp_path / "t"), rows, ["k"], "day", "h", count_by=["v"])
    assert {(r.v, r.day): r.rows_inserted for r in found.collect()} == {
        ("a", D1): 1, ("a", D2): 1, ("b", D2): 1,
    }


def test_upsert_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert upsert(spark, path, frame(spark), ["k"], "day", "h").count() == 0
    assert read_if_exists(spark, path) is None


def test_upsert_many_partitions_reads_a_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tablegate.operators.merge._LISTED_PARTITIONS", 1)
    path = str(tmp_path / "t")
    rows = frame(spark, (1, D1, "a", "x"), (2, D2, "b", "x"), (3, D3, "c", "x"))
    upsert(spark, path, rows, ["k"], "day", "h")
    again = frame(spark, (1, D1, "A", "y"), (3, D3, "c", "x"))
    assert totals(upsert(spark, path, again, ["k"], "day", "h")) == (0, 1)
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {1: "A", 2: "b", 3: "c"}


def test_incremental_merge_adds_a_column(spark, tmp_path):
    path = str(tmp_path / "mart")
    incremental_merge(spark, path, frame(spark, (1, D1, "a", "x"), (2, D2, "b", "x")), ["k"], "day")
    wider = spark.createDataFrame([(2, D2, "B", "x", 1.5)], SCHEMA + ", extra double")
    incremental_merge(spark, path, wider, ["k"], "day")
    rows = {r.k: r for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
    assert (rows[1].v, rows[1].extra, rows[2].v, rows[2].extra) == ("a", None, "B", 1.5)
    # A later run still sees the column, whichever file is read first.
    incremental_merge(spark, path, frame(spark, (1, D1, "A", "x"), (9, D2, "n", "x")), ["k"], "day")
    rows = {r.k: r for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
    assert (rows[1].v, rows[2].extra) == ("A", 1.5)


def test_hot_key_in_source_and_target(spark):
    """A third of all rows under one key must not change the result."""
    rows = [(1, D1, f"v{i}", f"h{i:04d}") for i in range(400)] + [
        (k, D1, "v", "h") for k in range(2, 802)
    ]
    source = dedupe_latest(frame(spark, *rows), ["k"], ["h"])
    merged = merge_rows(frame(spark, *rows), source, ["k"], "h").collect()
    assert len(merged) == 1200
    assert {r.v for r in merged if r.k == 1} == {"v399"}


@pytest.mark.parametrize("seed", range(3))
def test_merge_matches_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    days = [datetime(2025, 3, d).date() for d in range(1, 6)]

    def table(n):
        return {k: (k, days[k % 5], f"v{rng.random()}", rng.choice(["x", "y", None])) for k in rng.sample(range(200), n)}

    old, new = table(120), table(120)
    expected = dict(old)
    for k, row in new.items():
        if k not in old or (old[k][3] and row[3] and old[k][3] != row[3]):
            expected[k] = row
    merged = merge_rows(frame(spark, *old.values()), frame(spark, *new.values()), ["k"], "h")
    assert {r.k: tuple(r)[:4] for r in merged.collect()} == expected


def test_repeated_source_keys_need_an_order(spark, tmp_path):
    rows = spark.createDataFrame([(1, D1, "a"), (1, D1, "b")], "k int, day date, v string")
    with pytest.raises(ValueError, match="repeats keys"):
        incremental_merge(spark, str(tmp_path / "mart"), rows, ["k"], "day")


def test_first_load_needs_no_join(spark, tmp_path, monkeypatch):
    """A target without rows is known to be empty while planning."""
    seen, write = [], merge._write
    monkeypatch.setattr(merge, "_write", lambda merged, *rest: (seen.append(plan(merged)), write(merged, *rest)))
    path = str(tmp_path / "t")
    incremental_merge(spark, path, frame(spark, (1, D1, "a", "x"), (None, D2, "b", "y")), ["k"], "day")
    assert seen and "Join" not in seen[0] and read_if_exists(spark, path).count() == 2


def test_both_joins_read_the_source_by_one_shuffle(spark, tmp_path):
    rows = [(k, D1, f"v{k}", "h") for k in range(50)] + [(None, D1, "n", "h")]
    tables = []
    for name, part in (("a", rows[:30]), ("b", rows[10:])):
        frame(spark, *part).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_rows(*tables, ["k"])
        actions = sorted(r["_action"] for r in merged.collect())
        text = plan(merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert actions == ["insert"] * 21 + ["keep"] * 10 + ["update"] * 20
    assert "ReusedExchange" in text.split("Initial Plan")[0]
